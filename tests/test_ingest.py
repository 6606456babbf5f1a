"""Dumps, registry, runs and stores, against step-by-step Python on small inputs."""

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from creatorlens import schemas
from creatorlens.operators.joins import found_in
from creatorlens.plans import ingest
from creatorlens.sources import dumps, registry, tables
from creatorlens.sources.tables import CatalogStore, FolderStore
from creatorlens.sources.workspace import fresh_folder

NOW = "2024-01-01T00:00:00+00:00"
LISTING = "config_url string, tab string, position long, video_id string"


def lines(spark, *records):
    text = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(text, "value string")


# dumps


def test_listing_lines(spark):
    parsed = dumps.parse_listing(
        lines(
            spark, {"id": "a", "url": "u"}, {"id": "", "url": "b"}, {"url": "c", "x": [1]}, {"id": None},
            "{broken", "", "   ", "7", {"id": 12}, {},
        )
    )
    assert sorted(row.video_id for row in parsed.collect()) == ["12", "a", "b", "c"]


def test_video_fields(spark):
    rows = dumps.parse_videos(
        lines(
            spark,
            {"id": "full", "title": "T", "description": "d" * 1200, "channel": "C", "channel_id": "c",
             "channel_url": "u", "upload_date": "20240131", "duration": 61, "view_count": 5,
             "like_count": 6, "comment_count": 7, "tags": ["a", "b"], "categories": [],
             "thumbnail": "t", "language": "id", "is_live": True, "was_live": False},
            {"id": "absent"},
            {"id": "nulls", "title": None, "description": None, "channel": None, "upload_date": None,
             "view_count": None, "like_count": None, "comment_count": None, "tags": None,
             "is_live": None, "thumbnail": None},
            {"id": "odd", "upload_date": "yesterday", "title": "日本"},
            {"id": "types", "duration": 61.0, "view_count": "5", "like_count": {"n": 1}, "comment_count": 1.5,
             "is_live": "true", "was_live": 0, "tags": "x", "categories": [1, "b"], "title": 7},
            '{"id":"cut"', "[1]", "7", "null",
        ),
        NOW,
    )
    got = {row.video_id: row for row in rows.collect()}
    assert set(got) == {"full", "absent", "nulls", "odd", "types"}
    types = got["types"]
    assert (types.duration_seconds, types.view_count, types.like_count, types.comment_count) == (61, 5, None, None)
    assert (types.is_live, types.was_live, types.tags, types.categories, types.title) == (
        True, False, '"x"', '[1,"b"]', "7",
    )
    full, absent, nulls = got["full"], got["absent"], got["nulls"]
    assert (full.upload_date, len(full.description), full.tags) == ("2024-01-31", 1000, '["a","b"]')
    assert (full.categories, full.is_live, full.was_live) == ("[]", True, False)
    assert (absent.title, absent.channel_id, absent.view_count, absent.like_count) == ("", "", 0, 0)
    assert (absent.description, absent.upload_date, absent.duration_seconds) == ("", None, None)
    assert (absent.tags, absent.language, absent.is_live, absent.thumbnail_url) == ("[]", None, False, "")
    assert (nulls.title, nulls.view_count, nulls.comment_count, nulls.thumbnail_url) == (None, None, None, None)
    assert (nulls.description, nulls.tags, nulls.is_live) == ("", "[]", False)
    assert (got["odd"].upload_date, got["odd"].title) == ("yesterday", "日本")


def test_videos_are_known_by_the_requested_id(spark):
    asked = spark.createDataFrame([("r", '{"id":"own"}'), (None, '{"id":"b"}')], "requested_id string, value string")
    assert [row.video_id for row in dumps.parse_videos(asked, NOW).collect()] == ["r", "b"]


def test_lines_with_repeated_keys_keep_the_last_value(spark):
    values = ['{"id": "a", "title": "x", "title": "y", "tags": ["t", {"k": 1, "k": 2}], "view_count": 5}', '{"id": "b"', "[1]"]
    raw = spark.createDataFrame([(v,) for v in values], "value string")
    rows = dumps.parse_videos(raw, "now").select("video_id", "title", "tags", "view_count").collect()
    assert [tuple(r) for r in rows] == [("a", "y", '["t",{"k":2}]', 5)]
    assert [r["video_id"] for r in dumps.parse_listing(raw).collect()] == ["a"]


def test_lines_are_parsed_once(spark):
    plan = dumps.parse_videos(lines(spark, {"id": "a"}), NOW)
    text = plan.filter("view_count > 3")._jdf.queryExecution().optimizedPlan().toString()
    assert text.lower().count("parse_json(") + text.count("parseJson") == 1


def test_channel_merge(spark):
    def keyed(*pairs):
        return spark.createDataFrame([(u, json.dumps(v)) for u, v in pairs], "config_url string, value string")

    listing = keyed(
        ("u1", {"channel": "L", "channel_id": "l", "channel_url": "lu", "description": "ld", "url": "v1"}),
        ("u2", {"channel": "", "uploader": "U", "webpage_url": "http://w", "description": "x" * 600}),
        ("u3", {"channel": "N", "channel_id": None}),
        ("u4", {"channel": "only", "channel_id": "o"}),
        ("u5", {"channel": None, "uploader": None, "url": "v5"}),
        ("u6", {"channel": None, "url": "v6", "description": 5}),
    )
    extract = keyed(
        ("u1", {"channel": "F", "channel_id": "", "channel_follower_count": 9}),
        ("u4", {"channel": "not read", "channel_follower_count": 1}),
        ("u6", {"channel_follower_count": "12"}),
    )
    got = {row.config_url: row for row in dumps.parse_channels(listing, extract, NOW).collect()}
    assert tuple(got["u1"])[1:6] == ("l", "F", "lu", 9, "")
    assert tuple(got["u2"])[1:5] == ("", "U", "u2", None) and len(got["u2"].description) == 500
    assert (got["u3"].channel_id, got["u3"].description) == (None, "")
    assert (got["u4"].channel_name, got["u4"].subscriber_count) == ("only", None)
    assert (got["u5"].channel_name, got["u5"].channel_id) == (None, "")
    assert tuple(got["u6"])[1:6] == (None, "", "u6", 12, "")
    urls = {row.config_url: row.video_url for row in dumps.channel_probe_urls(listing).collect()}
    watch = "https://www.youtube.com/watch?v="
    assert urls == {"u1": watch + "v1", "u2": "http://w", "u5": watch + "v5", "u6": watch + "v6"}


# registry


DOCUMENT = {
    "tech": [
        {"name": "a", "url": "ua", "region": "ID"},
        {"name": "b", "url": "ub", "region": "GLOBAL", "channel_id": "cb", "status": "valid"},
    ],
    "music": [{"name": "c", "url": "uc", "region": "ID", "channel_id": None}],
}
FLAT = [
    ("a", "ua", None, "tech", "ID"),
    ("b", "ub", "cb", "tech", "GLOBAL"),
    ("c", "uc", None, "music", "ID"),
]


def test_registry_files(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps(DOCUMENT, indent=2))
    flat = registry.read_json(spark, str(tmp_path / "r.json")).orderBy("position")
    assert [tuple(row)[:5] for row in flat.collect()] == FLAT
    yaml = pytest.importorskip("yaml")
    (tmp_path / "r.yaml").write_text(yaml.safe_dump(DOCUMENT, sort_keys=False))
    flat = registry.read_yaml(spark, str(tmp_path / "r.yaml")).orderBy("position")
    assert [tuple(row)[:5] for row in flat.collect()] == FLAT
    assert registry.only_niche(flat, "music").count() == 1
    assert registry.only_niche(flat, None).count() == 3


def test_registry_resolution(spark):
    flat = registry.flatten(lines(spark, DOCUMENT))
    observed = spark.createDataFrame(
        [("ua", json.dumps({"channel": "A", "channel_id": None, "channel_url": ""}))],
        "url string, value string",
    )
    searches = spark.createDataFrame(
        [
            ("b", "tech", 0, "{bad"),
            ("b", "tech", 1, json.dumps({"channel": "no url"})),
            ("b", "tech", 3, json.dumps({"channel": "late", "channel_url": "x"})),
            ("b", "tech", 2, json.dumps({"uploader": "B!", "channel_url": "found"})),
            ("a", "tech", 1, json.dumps({"channel": "unused", "channel_url": "y"})),
        ],
        "name string, niche string, position int, value string",
    )
    resolved = registry.resolve(
        flat, dumps.observed_channels(observed), dumps.first_hits(searches)
    ).orderBy("position")
    assert [tuple(row)[:6] for row in resolved.collect()] == [
        ("A", "ua", None, "tech", "ID", "valid"),
        ("B!", "found", None, "tech", "GLOBAL", "found_via_search"),
        ("c", "uc", "", "music", "ID", "not_found"),
    ]
    counts = {row.niche: tuple(row)[1:] for row in registry.status_counts(resolved).collect()}
    assert counts == {"tech": (1, 1, 0), "music": (0, 0, 1)}


def test_positions_of_several_documents_do_not_meet(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps({"music": [{"name": "last", "url": "u3"}]}))
    (tmp_path / "a.json").write_text(json.dumps({"tech": [{"name": "first", "url": "u1"}, {"name": "second", "url": "u2"}]}))
    rows = registry.read_json(spark, str(tmp_path)).orderBy("position").collect()
    assert [row.name for row in rows] == ["first", "second", "last"]
    assert len({row.position for row in rows}) == 3


# runs


def one_by_one(listing, loaded, order, parsed, max_new, per_tab):
    """The run as a loop over registry entries (URLs in order): (entry, video)."""
    taken, result = set(loaded), set()
    for entry, channel in enumerate(order):
        tabs = {"videos": [], "streams": []}
        for url, tab, _, video in sorted(listing, key=lambda r: r[2]):
            if url == channel:
                tabs[tab].append(video)
        videos, streams = tabs["videos"][:per_tab], tabs["streams"][:per_tab]
        ids = videos + [s for s in streams if s not in videos]
        new = [v for v in ids if v not in taken][:max_new]
        result |= {(entry, v) for v in new}
        taken |= {v for v in new if v in parsed}
    return result


def claimed_rows(spark, listing, loaded, order, parsed, max_new, per_tab, **settings):
    entries = spark.createDataFrame(
        [(u, u, None, "tech", "ID", place) for place, u in enumerate(order)],
        "name string, url string, channel_id string, niche string, region string, position long",
    )
    listed = ingest.listed_videos(spark.createDataFrame(listing, LISTING), per_tab)
    one_column = lambda values: spark.createDataFrame([(v,) for v in values], "video_id string")
    return ingest.claims(listed, one_column(loaded), entries, one_column(parsed), max_new, **settings).collect()


@pytest.mark.parametrize("seed", range(4))
def test_claims_equal_the_loop(spark, seed):
    rng = random.Random(seed)
    ids = [f"v{i}" for i in range(30)]
    channels = [f"u{i}" for i in range(6)]
    listing = []
    for channel in channels:
        for tab in ("videos", "streams"):
            picked = rng.sample(ids, rng.randint(0, 12))
            listing += [(channel, tab, place, video) for place, video in enumerate(picked)]
    loaded = rng.sample(ids, 4)
    parsed = [v for v in ids if rng.random() < 0.8]
    order = rng.sample(channels, len(channels)) + rng.sample(channels, seed)  # some URLs twice
    expected = one_by_one(listing, loaded, order, set(parsed), max_new=4, per_tab=8)
    rows = claimed_rows(spark, listing, loaded, order, parsed, 4, 8)
    assert sorted((row.entry, row.video_id) for row in rows) == sorted(expected)
    in_rounds = claimed_rows(spark, listing, loaded, order, parsed, 4, 8, group_rows=20)
    assert sorted(map(tuple, in_rounds)) == sorted(map(tuple, rows))
    assert all(row.has_video == (row.video_id in parsed) and row.config_url == order[row.entry] for row in rows)


def test_claims_of_chains_and_of_equal_lists(spark):
    chain = [(f"u{i}", "videos", n, f"v{3 * i + n}") for i in range(12) for n in range(6)]
    same = [(f"w{i}", "videos", n, f"x{n}") for i in range(12) for n in range(9)]
    alone = [("alone", "videos", n, f"y{n}") for n in range(5)]
    order = [f"u{i}" for i in range(12)] + ["alone"] + [f"w{i}" for i in range(12)]
    listing = chain + same + alone
    ids = {row[3] for row in listing}
    want = sorted(one_by_one(listing, [], order, ids, 3, 10))
    for settings in ({}, {"group_rows": 0}):
        rows = claimed_rows(spark, listing, [], order, sorted(ids), 3, 10, **settings)
        assert sorted((r.entry, r.video_id) for r in rows) == want


def test_a_chain_of_a_thousand_entries_needs_no_rounds(spark, monkeypatch):
    listing = [(f"u{i}", "videos", n, f"v{3 * i + n}") for i in range(1000) for n in range(6)]
    order, ids = [f"u{i}" for i in range(1000)], {row[3] for row in listing}
    monkeypatch.setattr(ingest, "_settled", None)
    rows = claimed_rows(spark, listing, [], order, sorted(ids), 3, 10)
    taken, want = set(), set()
    for i in range(1000):
        new = [v for v in (f"v{3 * i + n}" for n in range(6)) if v not in taken][:3]
        want |= {(i, v) for v in new}
        taken |= set(new)
    assert {(r.entry, r.video_id) for r in rows} == want and len(rows) == len(want)


def test_later_rounds_take_few_rows(spark, monkeypatch):
    """What a round writes follows what was lost in the round before."""
    written = {}

    def counted(df, label, partition_by=()):
        done = materialize(df, label, partition_by)
        written.setdefault(label, []).append(done.count())
        return done

    from creatorlens.sources.workspace import materialize

    monkeypatch.setattr(ingest, "materialize", counted)
    chain = [(f"u{i}", "videos", n, f"v{i + n}") for i in range(6) for n in range(4)]
    alone = [(f"a{i}", "videos", n, f"a{i}-{n}") for i in range(50) for n in range(4)]
    order = [f"u{i}" for i in range(6)] + [f"a{i}" for i in range(50)]
    listing = chain + alone
    claimed_rows(spark, listing, [], order, sorted({r[3] for r in listing}), 2, 10)
    assert written["contested"] == [24] and written["candidates"] == [224]
    assert all(n <= 2 * max(lost, 1) for n, lost in zip(written["offers"][1:], written["losers"]))


def test_entries_with_one_url_load_under_their_own_niche(spark, run_inputs):
    entries, listing, channels, videos = run_inputs
    twice = entries.unionByName(
        entries.filter("url = 'ub'").withColumn("niche", F.lit("again")).withColumn("position", F.lit(10**15))
    )
    store = FolderStore(spark, fresh_folder(spark, "runs"))
    assert ingest.load_incremental(store, twice, listing, channels, videos, max_new=1)["videos"] == 3
    stored = store.read("raw_videos", schemas.RAW_VIDEOS).collect()
    assert sorted((r.video_id, r.niche) for r in stored) == [("a1", "tech"), ("b1", "again"), ("x", "tech")]


def test_streams_already_in_videos_are_dropped(spark):
    listing = spark.createDataFrame(
        [("u", "videos", 1, "a"), ("u", "streams", 1, "a"), ("u", "streams", 2, "b"), ("w", "streams", 1, "a")],
        LISTING,
    )
    got = {(r.config_url, r.tab, r.video_id) for r in ingest.listed_videos(listing).collect()}
    assert got == {("u", "videos", "a"), ("u", "streams", "b"), ("w", "streams", "a")}


@pytest.fixture()
def run_inputs(spark):
    entries = registry.flatten(lines(spark, DOCUMENT))
    listing = spark.createDataFrame(
        [("ua", "videos", 1, "a1"), ("ua", "videos", 2, "x"), ("ub", "videos", 1, "x"), ("ub", "streams", 2, "b1"),
         ("uc", "videos", 1, "gone"), ("stranger", "videos", 1, "s")],
        LISTING,
    )
    videos = dumps.parse_videos(
        lines(spark, *[{"id": v, "channel_id": "ch", "view_count": 1} for v in ("a1", "x", "b1", "s")]), NOW
    )
    channels = dumps.parse_channels(
        spark.createDataFrame(
            [("ua", '{"channel":"A","channel_id":"ca"}'), ("ub", '{"channel":"B","channel_id":"cb"}')],
            "config_url string, value string",
        ),
        spark.createDataFrame([], "config_url string, value string"),
        NOW,
    )
    return entries, listing, channels, videos


def test_incremental_runs_add_nothing_twice(spark, run_inputs):
    entries, listing, channels, videos = run_inputs
    store = FolderStore(spark, fresh_folder(spark, "runs"))
    first = ingest.load_incremental(store, entries, listing, channels, videos)
    second = ingest.load_incremental(store, entries, listing, channels, videos)
    assert first == {"videos": 3, "channels": 2} and second == {"videos": 0, "channels": 2}
    stored = store.read("raw_videos", schemas.RAW_VIDEOS).collect()
    assert sorted((r.video_id, r.niche, r.region) for r in stored) == [
        ("a1", "tech", "ID"), ("b1", "tech", "GLOBAL"), ("x", "tech", "ID"),
    ]
    assert store.read("raw_channels", schemas.RAW_CHANNELS).count() == 4


def test_full_run_replaces(spark, run_inputs):
    entries, listing, channels, videos = run_inputs
    store = FolderStore(spark, fresh_folder(spark, "runs"))
    for _ in range(2):
        written = ingest.load_full(
            store, ingest.raw_channels(entries, channels), ingest.full_videos(listing, entries, videos)
        )
        assert written == {"channels": 2, "videos": 4}
    stored = store.read("raw_videos", schemas.RAW_VIDEOS)
    assert sorted(r.video_id for r in stored.collect()) == ["a1", "b1", "x", "x"]


def test_outcomes_and_report(spark, run_inputs):
    entries, listing, channels, videos = run_inputs
    listed = ingest.listed_videos(listing)
    loaded = spark.createDataFrame([("a1",)], "video_id string")
    claimed = ingest.claims(listed, loaded, entries, videos)
    rows = ingest.incremental_outcomes(entries, channels, listed, loaded, claimed).collect()
    assert {r.config_url: (r.total_found, r.existing, r.new_videos, r.skipped) for r in rows} == {
        "ua": (2, 1, 1, False), "ub": (2, 0, 1, False), "uc": (1, 0, 0, True),
    }
    full = ingest.full_outcomes(entries, channels, listed, videos)
    assert tuple(ingest.run_report(full).first()) == (3, 2, 1, 1, 4)
    assert [r.name for r in ingest.failed_channels(entries, channels).collect()] == ["c"]


# stores


@pytest.mark.parametrize("kind", ["folder", "catalog"])
def test_store_modes(spark, kind):
    store = FolderStore(spark, fresh_folder(spark, "s")) if kind == "folder" else CatalogStore(spark, "modes")
    schema = schemas.PROBE_TABLE
    rows = [("abc123", "Test Video 1", 1000, date(2025, 1, 1)), ("def456", "Test Video 2", 5000, date(2025, 2, 15)),
            ("ghi789", "Test Video 3", 250, date(2025, 3, 20))]
    df = spark.createDataFrame(rows, schema)
    assert not store.exists("probe")
    assert tables.loaded_keys(store, "probe", schema, "video_id").isEmpty()
    assert tables.load(df.limit(0), store, "probe") == 0 and not store.exists("probe")
    assert tables.load(df, store, "probe", tables.CREATE) == 3
    with pytest.raises(Exception, match="(?i)already exists"):
        tables.load(df, store, "probe", tables.CREATE)
    assert tables.load(df, store, "probe") == 3
    assert store.read("probe", schema).count() == 6
    assert tables.loaded_keys(store, "probe", schema, "video_id").count() == 3
    assert tables.load(df.limit(1), store, "probe", tables.OVERWRITE) == 1
    assert store.read("probe", schema).count() == 1
    if kind == "catalog":
        spark.sql(f"DROP TABLE IF EXISTS {store.locate('probe')}")
        assert not store.exists("probe")


@pytest.mark.parametrize("kind", ["folder", "catalog"])
def test_a_failing_write_leaves_the_old_table(spark, kind):
    store = FolderStore(spark, fresh_folder(spark, "s")) if kind == "folder" else CatalogStore(spark, "failing")
    schema = schemas.PROBE_TABLE
    good = spark.createDataFrame([("a", "t", 1, None)], schema)
    assert tables.load(good, store, "probe", tables.OVERWRITE) == 1
    bad = good.unionByName(spark.createDataFrame([("b", "t", 2, None)], schema)).withColumn(
        "views", F.when(F.col("video_id") == "b", F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("views"))
    )
    with pytest.raises(Exception, match="broken"):
        tables.load(bad, store, "probe", tables.OVERWRITE)
    assert [r.video_id for r in store.read("probe", schema).collect()] == ["a"]


def test_required_columns(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "video_id string, views long")
    df = df.withColumn("title", F.lit(None)).withColumn("upload_date", F.lit("2024-01-01"))
    good = tables.required(df.filter("views = 1"), schemas.PROBE_TABLE).collect()
    assert tuple(good[0]) == ("a", None, 1, date(2024, 1, 1))
    with pytest.raises(Exception, match="video_id is NULL"):
        tables.required(df, schemas.PROBE_TABLE).collect()


def test_coerce(spark):
    df = spark.createDataFrame(
        [("v", "12", None, "true"), ("w", None, True, None)],
        "video_id string, view_count string, is_live boolean, was_live string",
    )
    got = tables.coerce(df, schemas.RAW_VIDEOS)
    assert got.dtypes == [
        ("video_id", "string"), ("view_count", "bigint"), ("is_live", "boolean"), ("was_live", "boolean"),
    ]
    assert [tuple(r) for r in got.collect()] == [("v", 12, False, True), ("w", None, True, False)]


def test_retention_is_inclusive(spark):
    stamps = ["2024-01-01T23:59:59+00:00", "2024-01-02T00:00:00+00:00", "2024-03-01T08:00:00.5+00:00", None]
    df = spark.createDataFrame([(s,) for s in stamps], "scraped_at string")
    kept = [r.scraped_at for r in tables.within_retention(df, date(2024, 3, 2)).collect()]
    assert kept == stamps[1:3]
    assert tables.within_retention(df).isEmpty()


def test_union_batches_and_query(spark):
    a = spark.createDataFrame([(1, "x")], "n long, t string")
    b = spark.createDataFrame([(2,)], "n long")
    both = ingest.union_batches([a, b, a.limit(0)])
    assert sorted(map(tuple, both.collect())) == [(1, "x"), (2, None)]
    got = tables.query(spark, "SELECT n FROM numbers WHERE t = :t", {"numbers": both}, t="x' OR '1'='1")
    assert got.isEmpty()
    assert {tuple(r) for r in ingest.table_counts({"a": a, "both": both}).collect()} == {("a", 1), ("both", 2)}


def test_utc_now(spark):
    text = spark.range(1).select(dumps.utc_now().alias("t")).first().t
    assert text.endswith("+00:00") and "T" in text


def test_lists_end_where_nobody_can_take_more(spark, monkeypatch):
    """Of an entry only the ids go on up to its last that no earlier entry lists."""
    written = {}

    def counted(df, label, partition_by=()):
        done = materialize(df, label, partition_by)
        written.setdefault(label, []).append(done.count())
        return done

    from creatorlens.sources.workspace import materialize

    monkeypatch.setattr(ingest, "materialize", counted)
    chain = [(f"u{i}", "videos", n, f"v{i + n}") for i in range(6) for n in range(4)]
    alone = [(f"a{i}", "videos", n, f"a{i}-{n}") for i in range(5) for n in range(4)]
    order = [f"u{i}" for i in range(6)] + [f"a{i}" for i in range(5)]
    ids = {r[3] for r in chain + alone}
    rows = claimed_rows(spark, chain + alone, [], order, sorted(ids), 2, 10)
    assert sorted((r.entry, r.video_id) for r in rows) == sorted(one_by_one(chain + alone, [], order, ids, 2, 10))
    # two of the first entry's, all four of the five behind it, two of each that shares none
    assert written["within-reach"] == [2 + 5 * 4 + 5 * 2]


def test_entries_without_a_place_take_what_is_left(spark):
    listing = [("a", "videos", 1, "x"), ("b", "videos", 1, "x"), ("b", "videos", 2, "y"),
               ("none", "videos", 1, "x"), ("none", "videos", 2, "y"), ("none", "videos", 3, None)]
    entries = spark.createDataFrame([("a", 0), ("b", 1), ("none", None)], "url string, position long")
    videos = spark.createDataFrame([("x",), ("y",)], "video_id string")
    listed = ingest.listed_videos(spark.createDataFrame(listing, LISTING))
    rows = ingest.claims(listed, videos.limit(0), entries, videos).collect()
    assert {tuple(r) for r in rows} == {
        (0, "a", "x", True), (1, "b", "y", True), (None, "none", "y", True), (None, "none", None, False),
    }


def test_histories_too_large_to_send_keys_to(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "video_id string")
    history = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "video_id string")
    for bound in (0, 10**6):
        found = found_in(ids, "video_id", {"old": history, "new": history.limit(0)}, broadcast_bytes=bound)
        assert sorted(map(tuple, found.collect())) == [("a", True, False), ("b", False, False), ("c", False, False)]
