"""Lines that can't be loaded are kept with a reason; all lines are accounted for."""

from creatorlens.plans import staging
from creatorlens.sources import dumps, quarantine
from creatorlens.sources.quarantine import PARSED, sort_videos

STAMP = "2024-01-01T00:00:00+00:00"
LINES = [
    ("a", '{"id": "a", "upload_date": "20240229"}', None),
    ("b", '{"id": "b", "upload_date": "20230229"}', dumps.NO_DAY),
    ("c", '{"id": "c", "upload_date": ""}', None),
    ("d", '{"id": "d"', dumps.NO_JSON),
    ("e", "[1, 2]", dumps.NO_OBJECT),
    ("f", "null", dumps.NO_OBJECT),
    ("g", "  ", dumps.EMPTY_LINE),
    ("h", None, dumps.EMPTY_LINE),
    ("i", '{"title": "no id", "upload_date": "nonsense"}', dumps.NO_ID),
    ("a", '{"id": "a", "upload_date": "20240229"}', None),
    ("k", '{"id": "k", "upload_date": "2024-02-29", "view_count": {"n": 1}}', None),
    ("l", "x" * 300_000, dumps.NO_JSON),
]


def lines_of(spark, rows):
    return spark.createDataFrame(rows, "name string, value string, reason string")


def test_every_line_has_a_fate(spark):
    lines = lines_of(spark, LINES)  # its column ``reason`` is not the one of the result
    done = sort_videos(lines, STAMP)
    want = sorted((n, v or "", r) for n, v, r in LINES if r)
    assert sorted((r["name"], r["value"] or "", r["reason"]) for r in done.set_aside.collect()) == want
    assert {r["scraped_at"] for r in done.set_aside.collect()} == {STAMP}
    good = lines_of(spark, [row for row in LINES if row[2] is None])
    plain = dumps.parse_videos(good, STAMP)
    assert done.rows.columns == plain.columns
    assert sorted(map(str, done.rows.collect())) == sorted(map(str, plain.collect()))
    assert sum(done.counts.values()) == len(LINES) and done.counts[PARSED] == 4
    assert done.counts == {PARSED: 4} | {r: sum(row[2] == r for row in LINES) for r in dumps.REASONS}


def test_the_models_take_what_is_left(spark):
    done = sort_videos(lines_of(spark, LINES), STAMP)
    rows = done.rows.selectExpr("*", "'n' AS niche", "'ID' AS region")
    assert staging.stg_videos(rows).count() == 4


def test_mended_lines_and_no_lines(spark):
    done = sort_videos(lines_of(spark, LINES), STAMP)
    mended = done.set_aside.selectExpr("name", "replace(value, '20230229', '20230228') AS value", "scraped_at")
    again = sort_videos(mended, STAMP)
    assert [r["video_id"] for r in again.rows.collect()] == ["b"]
    none = sort_videos(lines_of(spark, []), STAMP)
    assert none.rows.isEmpty() and none.set_aside.isEmpty() and set(none.counts.values()) == {0}


def test_parsed_once(spark):
    judged = dumps.judged_videos(lines_of(spark, LINES), STAMP)
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map<string,variant>") <= 2 and plan.count("Generate") == 1
    assert quarantine.REASONS == dumps.REASONS
