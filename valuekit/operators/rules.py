"""Rule-based labels as one native expression.

A :class:`RuleSet` is data: an ordered list of labels, each with
``(condition, points)`` pairs, where a condition is a Column or SQL text.
:meth:`RuleSet.apply` compiles it into native expressions: per label
``sum(CASE WHEN cond THEN points ELSE 0 END)``, then the first label (in list
order) whose score equals the ``greatest`` of all scores. Any NULL input
short-circuits to the fallback label. No Python worker is involved, so the
labelling stays inside whole-stage codegen. SQL-text conditions become one
``expr`` per label, which keeps plan construction to a handful of calls.

Threshold tests compare FloatType columns against double literals, like the
source (float 0.12 >= 0.12 is false), and NaN fails every threshold as in a
Python comparison.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuekit.functions.columns import sql_text



@dataclass
class RuleSet:
    labels: Sequence[tuple[str, Sequence[tuple[Column | str, int]]]]
    required: Sequence[str] = ()
    fallback: str | None = None
    constant_points: Mapping[str, int] = field(default_factory=dict)

    def score_exprs(self) -> list[tuple[str, Column]]:
        out = []
        for name, rules in self.labels:
            base = int(self.constant_points.get(name, 0))
            if all(isinstance(c, str) for c, _ in rules):
                terms = [str(base)] + [f"(CASE WHEN {c} THEN {int(p)} ELSE 0 END)" for c, p in rules]
                out.append((name, F.expr(" + ".join(terms))))
                continue
            total = F.lit(base)
            for cond, pts in rules:
                cond = F.expr(cond) if isinstance(cond, str) else cond
                total = total + F.when(cond, F.lit(int(pts))).otherwise(F.lit(0))
            out.append((name, total))
        return out

    def _label(self, scores: list[tuple[str, Column]], best: Column) -> Column:
        label = F.coalesce(*[F.when(s == best, F.lit(name)) for name, s in scores])
        if self.required:
            any_null = F.expr(" OR ".join(f"{_q(c)} IS NULL" for c in self.required))
            label = F.when(any_null, F.lit(self.fallback)).otherwise(label)
        return label

    def label_expr(self) -> Column:
        """The label as one expression (each score appears several times; fine
        for a handful of rules, see :meth:`apply` for large rule sets)."""
        scores = self.score_exprs()
        best = F.greatest(*[s for _, s in scores]) if len(scores) > 1 else scores[0][1]
        return self._label(scores, best)

    def apply(self, df: DataFrame, out: str) -> DataFrame:
        """Add the label column in three projections: scores, best score, label.
        Catalyst does not collapse projections that would copy a non-trivial
        expression, so every score is computed once and the generated code
        stays within the JIT's method-size limit (one fused expression for
        eight labels exceeds it and falls back to interpreted evaluation)."""
        scored = self.score_exprs()
        tmp = [f"__score_{i}" for i in range(len(scored))]
        df = df.withColumns({t: e for t, (_, e) in zip(tmp, scored)})
        df = df.withColumn("__best", F.greatest(*[F.col(t) for t in tmp]) if len(tmp) > 1 else F.col(tmp[0]))
        label = self._label([(name, F.col(t)) for t, (name, _) in zip(tmp, scored)], F.col("__best"))
        return df.withColumn(out, label).drop(*tmp, "__best")


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def at_least(c: str, t: float) -> str:
    """SQL text: c >= t, false for NaN (Python semantics); t is a double
    literal, so a FloatType column is widened as in a Column comparison."""
    return f"(NOT isnan({_q(c)}) AND {_q(c)} >= {float(t)!r}D)"


def below(c: str, t: float) -> str:
    return f"(NOT isnan({_q(c)}) AND {_q(c)} < {float(t)!r}D)"


def sum_at_least(a: str, b: str, t: float) -> str:
    s = f"({_q(a)} + {_q(b)})"
    return f"(NOT isnan({s}) AND {s} >= {float(t)!r}D)"


def one_of(c: str, values: Sequence[str]) -> str:
    return f"({_q(c)} IN (" + ", ".join(sql_text(v) for v in values) + "))"


def archetype_rules(
    pos: str = "pos", usg: str = "usg_pct", pts36: str = "pts_per36", ts: str = "ts_pct",
    fg3a36: str = "fg3a_per36", stl36: str = "stl_per36", blk36: str = "blk_per36",
    ast36: str = "ast_per36", ast_pct: str = "ast_pct", blk_pct: str = "blk_pct",
    orb_pct: str = "orb_pct", trb36: str = "trb_per36", ws48: str = "ws_per_48",
    fg3a_share: str = "fg3a_per_fga_pct",
) -> RuleSet:
    """The eight player archetypes over 14 inputs (column names are parameters)."""
    ge, lt = at_least, below
    # Position groups.
    guard = one_of(pos, ("PG", "SG", "G"))
    wing = one_of(pos, ("SF", "SG-SF", "SF-SG", "F"))
    big = one_of(pos, ("PF", "C", "C-PF", "PF-C", "F-C"))

    def both(*conds: str) -> str:
        return "(" + " AND ".join(conds) + ")"

    # Label order (ties go to the earlier label), rules and points.
    labels = [
        ("Elite Scorer", [(ge(usg, 25), 2), (ge(pts36, 20), 2), (ge(ts, 0.56), 1),
                          (both(ge(usg, 22), ge(pts36, 18)), 1)]),
        ("3-and-D Wing", [(ge(fg3a_share, 0.45), 2), (ge(fg3a36, 5.0), 1), (sum_at_least(stl36, blk36, 2.5), 2),
                          (wing, 1), (lt(ast36, 3.5), 1)]),
        ("Playmaking Engine", [(ge(ast_pct, 28), 3), (ge(ast36, 7.0), 2), (guard, 1), (ge(usg, 22), 1)]),
        ("Rim Protector", [(ge(blk_pct, 4.0), 3), (ge(blk36, 2.0), 2), (big, 1), (ge(orb_pct, 8.0), 1),
                           (ge(trb36, 9.0), 1)]),
        ("Stretch Big", [(both(big, ge(fg3a_share, 0.30)), 3), (both(big, ge(fg3a36, 3.5)), 2),
                         (lt(ast36, 3.0), 1)]),
        ("Two-Way Anchor", [(sum_at_least(stl36, blk36, 3.0), 2), (ge(ws48, 0.12), 2),
                            (both(ge(blk_pct, 2.5), ge(stl36, 1.0)), 2)]),
        ("Combo Guard", [(both(guard, ge(pts36, 14), ge(ast36, 3.5)), 3), (both(guard, ge(fg3a_share, 0.30)), 1),
                         (both(guard, lt(usg, 25)), 1)]),
        ("Role Player / Glue Guy", []),
    ]
    required = [pos, usg, pts36, ts, fg3a36, stl36, blk36, ast36, ast_pct, blk_pct, orb_pct, trb36, ws48,
                fg3a_share]
    return RuleSet(labels=labels, required=required, fallback="Role Player / Glue Guy",
                   constant_points={"Role Player / Glue Guy": 1})
