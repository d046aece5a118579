"""The stateless cleaning and metric operators apply unchanged to a
streaming DataFrame (the source has no streams; nothing stream-specific is
built). File source in, memory sink out, one trigger."""

import os
import tempfile

from fixture_paths import FIXTURES
from valuekit import schemas as K
from valuekit.operators import clean as CL
from valuekit.operators import metrics as M


def test_row_level_operators_on_a_stream(spark):
    src = tempfile.mkdtemp(prefix="valuekit-stream-src-")
    with open(os.path.join(FIXTURES, "raw", "nba_stats.csv")) as f, open(os.path.join(src, "part-0.csv"), "w") as g:
        g.write(f.read())
    stream = spark.readStream.schema(K.STATS_SCHEMA).option("header", "true").csv(src)
    cleaned = CL.add_season_start_year(M.per_game_rates(
        CL.null_outside(CL.drop_sentinels(CL.strip_carriage_returns(stream), "season", K.SEASON_SENTINELS),
                        K.SHOOTING_BOUNDS)))
    assert cleaned.isStreaming
    q = (cleaned.select("player_id", "season", "team_name_abbr", "fg_pct", "pts_per_game", "season_start_year")
         .writeStream.format("memory").queryName("stats_stream").outputMode("append")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="valuekit-stream-ckpt-")).start())
    try:
        q.processAllAvailable()
        rows = spark.sql("SELECT * FROM stats_stream").collect()
    finally:
        q.stop()
    assert len(rows) == 6  # the 'N/A' season row is dropped
    p3 = [r for r in rows if r.player_id == "p3" and r.season == "2023-24"][0]
    assert p3.fg_pct is None and p3.pts_per_game == 5.0 and p3.season_start_year == 2023
