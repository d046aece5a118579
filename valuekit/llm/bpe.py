"""Operator 5: byte-level BPE as a bounded-lookahead streaming transducer.

A merge list fixes how far to the right of a boundary any byte can still
change the tokens before it. :class:`Transducer` derives that lookahead from
the merge list. It reads a pre-token from left to right, holding the tokens
that may still change, and emits a token once the reading place is that far
behind it, so what it holds does not grow with the text. Decoding maps ids to
bytes and runs an incremental bytes-to-text state machine over them.

Its transitions: a token sequence is what the merges make of its bytes exactly
if each two neighbours are what the merges make of their joint bytes. So the
state is the last token; the next is the longest vocabulary entry that may
follow it; where none may, the last token gives way to its next shorter one.
Which tokens may follow which is found with the merges, once a pair.

Defined results: null and empty texts have no ids and decode to the empty
text; texts of any length are streamed; repeated rows each get their row;
columns of the input other than the two named ones are not read.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.common import kept_in_process, read_table, ship, text_or_empty

ship(__name__)

#: Fixed value: the public split pattern of byte-level BPE vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary:
    printable Latin-1 bytes stand for themselves, the others take the code
    points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Follows(dict):
    """(a, b) -> whether the merges make exactly a, b of their joint bytes."""

    def __init__(self, coder: "Transducer", limit: int = 1_000_000):
        super().__init__()
        self.coder, self.limit = coder, limit

    def __missing__(self, pair: tuple[int, int]) -> bool:
        if len(self) >= self.limit:
            self.clear()
        table, single = self.coder.bytes_of, self.coder.single
        ids = self.coder.apply_merges([single[x] for x in table[pair[0]] + table[pair[1]]])
        self[pair] = known = ids == list(pair)
        return known


class Words(dict):
    """pre-token -> (ids, the ids in decimal, their bytes); emptied when it
    holds ``limit`` words, and long pre-tokens are never kept."""

    def __init__(self, coder: "Transducer", limit: int):
        super().__init__()
        self.coder, self.limit = coder, limit

    def __missing__(self, word: str) -> tuple[list[int], str, bytes]:
        ids = [i for part in self.coder.stream(word.encode("utf-8", "surrogatepass")) for i in part]
        known = ids, ",".join(map(str, ids)), b"".join([self.coder.bytes_of[i] for i in ids])
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = known
        return known


class Transducer:
    """Streaming encoder and decoder of one tokenizer file."""

    def __init__(self, path: str, cache_words: int = 300_000, window: int = 1 << 16):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        symbols = byte_symbols()
        byte_of = {s: b for b, s in enumerate(symbols)}
        self.single = [vocab[s] for s in symbols]
        self.rank = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(merges)}
        self.merge = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        self.bytes_of = {i: bytes(byte_of[c] for c in tok) for tok, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, i in self.added.items():
            self.bytes_of[i] = text.encode()
        self.added_split = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.split = regex.compile(SPLIT)
        self.lookahead = self._sufficient_lookahead(merges)
        self.follows = Follows(self)
        self.id_of = {b: i for i, b in self.bytes_of.items() if i not in self.added.values()}
        self.longest: dict[bytes, int] = {}  # by the first two bytes
        for b in self.id_of:
            self.longest[b[:2]] = max(self.longest.get(b[:2], 1), len(b))
        self.window = max(window, 8 * self.lookahead)
        self.words = Words(self, cache_words)

    def _sufficient_lookahead(self, merges: list[tuple[str, str]]) -> int:
        """Whether rule r = (a, b) fires depends on b standing there alone at
        its turn. Only an earlier rule that takes b, or the last piece of b
        before b was whole, together with text on its right can prevent that,
        and that rule in turn depends on still earlier ones. The largest sum
        of right-hand lengths along such a chain of falling ranks bounds how
        far to the right anything can matter."""
        last_piece: dict[str, str] = {}
        reach: dict[str, int] = {}  # left piece -> farthest reach of the rules so far that begin with it
        most = 0
        for a, b in merges:
            far, piece = 0, b
            while piece is not None:
                far = max(far, reach.get(piece, 0))
                piece = last_piece.get(piece)
            far += len(b)
            reach[a] = max(reach.get(a, 0), far)
            most = max(most, far)
            last_piece.setdefault(a + b, b)
        return most + max((len(a + b) for a, b in merges), default=1)

    def apply_merges(self, ids: list[int]) -> list[int]:
        merge = self.merge
        if len(ids) <= 48:  # short: one place at a time
            rank, none = self.rank.get, len(self.rank)
            ranks = [rank(p, none) for p in zip(ids, ids[1:])]
            while ranks and (least := min(ranks)) < none:
                i = ranks.index(least)
                ids[i:i + 2] = [merge[ids[i], ids[i + 1]][1]]
                del ranks[i]
                if i:
                    ranks[i - 1] = rank((ids[i - 1], ids[i]), none)
                if i < len(ranks):
                    ranks[i] = rank((ids[i], ids[i + 1]), none)
            return ids
        while len(ids) > 1:  # long: all places of the best pair at once
            best = min(((merge[p][0], p) for p in zip(ids, ids[1:]) if p in merge), default=None)
            if best is None:
                break
            a, b = best[1]
            new, out, i, n = merge[a, b][1], [], 0, len(ids)
            while i < n:
                if i + 1 < n and ids[i] == a and ids[i + 1] == b:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def stream(self, data: bytes) -> Iterator[list[int]]:
        """Token ids of one pre-token, each emitted once it is stable."""
        id_of, follows, table, longest, n = self.id_of.get, self.follows, self.bytes_of, self.longest.get, len(data)
        held: list[int] = []
        last, at, emitted = -1, 0, 0  # emitted: where the held tokens begin
        while at < n:
            end = min(n, at + longest(data[at:at + 2], 1))
            while True:
                if end == at:  # nothing may stand here after the last token
                    held.pop()
                    end, at = at - 1, at - len(table[last])
                    last = held[-1] if held else -1
                    continue
                token = id_of(data[at:end])
                if token is not None and (last < 0 or follows[last, token]):
                    break
                end -= 1
            held.append(token)
            last, at = token, end
            if at - emitted > 4 * self.lookahead:
                done, keep = emitted, 0
                for token in held:
                    if done + len(table[token]) > at - self.lookahead:
                        break
                    done += len(table[token])
                    keep += 1
                yield held[:keep]
                held, emitted = held[keep:], done
        yield held

    def _plain(self, text: str) -> Iterator[list[tuple[list[int], str, bytes]]]:
        """The pre-tokens of a text without added tokens, window by window.
        Those that reach the end of the window wait for more text; the window
        grows while a single pre-token fills it."""
        at, size, n = 0, self.window, len(text)
        while at < n:
            end = min(n, at + size)
            found = self.split.findall(text[at:end])
            if end < n:
                found = found[:-2]  # the last ones may still change
                if not found:
                    size *= 2
                    continue
            size = self.window
            yield list(map(self.words.__getitem__, found))
            at += sum(map(len, found))

    def pieces(self, text: str) -> Iterator[list[tuple[list[int], str, bytes]]]:
        """(ids, the same ids in decimal, their bytes) of consecutive parts."""
        at = 0
        if self.added_split is not None:
            for m in self.added_split.finditer(text):
                yield from self._plain(text[at:m.start()])
                i = self.added[m.group()]
                yield [([i], str(i), self.bytes_of[i])]
                at = m.end()
        yield from self._plain(text[at:] if at else text)

    def encode(self, text: str | None) -> list[int]:
        return [i for part in self.pieces(text or "") for ids, _, _ in part for i in ids]

    def decode(self, ids) -> Iterator[str]:
        """Text parts of the ids; bytes that are no UTF-8 become U+FFFD."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            yield machine.decode(self.bytes_of.get(i, b""))
        yield machine.decode(b"", final=True)

    def round_trip(self, text: str | None) -> tuple[int, str, str]:
        """n_tokens, digest of the decimal ids, digest of the decoded text,
        in one pass that keeps one window of each."""
        id_digest, text_digest, n, comma = sha256(), sha256(), 0, ""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for part in self.pieces(text or ""):
            ids, decimals, data = zip(*part)
            n += sum(map(len, ids))
            id_digest.update((comma + ",".join(decimals)).encode())
            text_digest.update(machine.decode(b"".join(data)).encode())
            comma = ","
        text_digest.update(machine.decode(b"", final=True).encode())
        return n, id_digest.hexdigest(), text_digest.hexdigest()


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text; one row per input row."""
    def run(batches):
        coder = kept_in_process(("bpe", path), lambda: Transducer(path))
        for batch in batches:
            got = [coder.round_trip(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([g[0] for g in got], pa.int64()),
                pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, SCHEMA)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
