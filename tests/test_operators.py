"""Operators against brute force and small cases."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens import fixed_values as fv
from postlens.operators import assets, chunks, keys, lookups, merge, pages, quality, ranking, throttle, vectors
from postlens.sources import schemas, tables
from postlens.streaming.throttle import throttle_stream


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ---- lookups, keys, ranks ------------------------------------------------------------------


def test_regex_lookup_fans_out_and_keeps_unmatched_rows(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "b"), (3, "x"), (4, None)], "i int, s string")
    got = lookups.regex_lookup(df, F.col("s"), [("a", "A"), ("b", "B"), (r"it's\s", "C")], ["hit"])
    assert rows(got, "i", "hit") == [(1, "ab", "A"), (1, "ab", "B"), (2, "b", "B"), (3, "x", None), (4, None, None)]


def test_regex_lookup_groups_equal_single_patterns(spark):
    words = [f"w{i:02d}" for i in range(40)]
    df = spark.createDataFrame([(" ".join(random.Random(i).sample(words, 3)),) for i in range(30)], "s string")
    got = lookups.regex_lookup(df, F.col("s"), [(w, w) for w in words], ["hit"])
    assert sorted(rows(got)) == sorted((s, w) for (s,) in rows(df) for w in words if w in s)


def test_city_patterns_keep_their_quirks(spark):
    from postlens.plans.silver import split_locations, with_city

    df = spark.createDataFrame([("bà rịa - vũng tàu",), ("hà nội - hcm",), (None,), ("nơi khác",)], "working_location string")
    got = rows(with_city(split_locations(df)), "working_location")
    assert got == [("bà rịa", None), ("hcm", "Ho Chi Minh City"), ("hà nội", "Ha Noi"), ("vũng tàu", None)]


def test_regex_lookup_of_patterns_that_stand_alone(spark):
    """References, named groups, quoting and comments keep their meaning in a long list."""
    patterns = [f"(w{i:02d})x" for i in range(20)] + [r"(z)\1", r"(?<n>q)\k<n>", r"\Qa(b", "(?x) c d # note", "(?i)ABC", "(?:e|f)g"]
    texts = ["zz", "z", "qq", "q", "a(b", "cd", "xabcx", "fg", "w03x zz", "w19x", "nothing", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = lookups.regex_lookup(df, F.col("s"), [(p, p) for p in patterns], ["hit"])
    single = df
    for p in patterns:
        single = single.withColumn(p.replace("`", ""), F.col("s").rlike(p))
    expected = []
    for r in single.collect():
        hits = [p for p, ok in zip(patterns, list(r)[1:]) if ok]
        expected += [(r["s"], p) for p in hits] or [(r["s"], None)]
    assert sorted(rows(got), key=str) == sorted(expected, key=str)


def test_lookup_join_with_a_hot_and_a_null_key(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot").otherwise("x").alias("k"))
    right = spark.createDataFrame([("hot", 1), ("y", 2)], "k string, v int")
    got = lookups.lookup_join(left, right, "k")
    assert got.count() == 1000 and got.filter("v = 1").count() == 333


@pytest.mark.parametrize("literals", [1, 100])
def test_pattern_join_by_literals_and_by_join(spark, literals):
    table = spark.createDataFrame([("a", "A"), ("b", "B"), ("^c", "C"), (None, "D")], "pattern string, v string")
    df = spark.createDataFrame([("ab",), ("cc",), ("x",), (None,)], "s string")
    got = lookups.pattern_join(df, F.col("s"), table, "pattern", ["v"], literals)
    assert sorted(rows(got), key=str) == sorted([("ab", "A"), ("ab", "B"), ("cc", "C"), ("x", None), (None, None)], key=str)


@pytest.mark.parametrize("chunk, literals", [(1000, 1), (7, 2)])
def test_indexed_patterns_match_as_each_does_alone(spark, chunk, literals):
    """Patterns with and without literals, flags, alternatives, optional parts; repeated rows and patterns."""
    patterns = [r"\bdata\b", r"data|info", r"(?i)KỸ sư", r"(?iu)Kit", r"x?y*z", r"^\d+$", r"ab{2,}c", r"(ab)?cd", r"[ab]+ro", r"a\.b", r"(?:one|two) three"]
    patterns += [f"(?i)word{k}\\b" for k in range(40)] + [r"data|info", None, r"q(?=u)uick", r"(?<n>hel)lo \k<n>", "no match here"]
    texts = ["data", "metadata info", "kỹ Sư", "KIT", "\u212ait", "k\u0131t", "xyz", "z", "12", "abbbc", "cd", "abro", "a.b", "two three", "WORD1 word39", "quick", "hello hel", "", None, "data"]
    df = spark.createDataFrame([(t, i % 2) for i, t in enumerate(texts)], "s string, _row int")
    table = spark.createDataFrame([(p, f"v{i}") for i, p in enumerate(patterns)], "pattern string, v string")
    got = lookups.pattern_join(df, F.col("s"), table, "pattern", ["v"], literals, chunk)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    expected = lookups.regex_lookup(df, F.col("s"), [(p, f"v{i}") for i, p in enumerate(patterns) if p is not None], ["v"])
    assert sorted(rows(got), key=str) == sorted(rows(expected), key=str)


def test_placed_clauses():
    from postlens.functions.patterns import placed_clauses

    known = {  # the last clause of each
        r"\border 12\b": [("order 12", True, True)], "(?i)PART (no )?0*12$": [("012", False, True), ("part 12", False, True), ("part no 12", False, True)],
        r"\bx?yz": [("xyz", True, False), ("yz", True, False)], "0*12": [("12", False, False)], r"^a\.$": [("a.", True, False)],
        r"ab$?c": [("ab", False, False)], r"a\b{g}bc": None, "(ab|cd)+ef": [("abef", False, False), ("cdef", False, False)],
        "(?iu)(no )?task": [("ta", False, False)], r"\b(?i)AB|cd$": [("ab", True, False), ("cd", False, True)],
        "(a|b|c)(a|b|c)(a|b|c)de": [("ade", False, False), ("bde", False, False), ("cde", False, False)], "(?!ab)cd": [("cd", False, False)],
    }
    got = {p: placed_clauses(p) for p in known}
    assert {p: [tuple(literal) for literal in c[-1]] if c else None for p, c in got.items()} == known


def test_a_long_pattern_table_is_joined_at_once(spark):
    """No pass over the texts for each part of the patterns; literals of all lengths, at edges of words and not."""
    from postlens import session

    random.seed(3)
    words = ["a", "ab", "12", "120", "0120", "é", "_x", "long" * 40, "ro se", "Ab", "\u212a"]
    texts = ["".join(random.choice(words) + random.choice(["", " ", "-", "\n"]) for _ in range(8)) for _ in range(60)] + ["", None]
    patterns = [f"{a}{w}{z}" for w in words for a in ("", r"\b", "^", "(?i)", "0*", "(no )?", "[a-z]") for z in ("", r"\b", "$")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    table = spark.createDataFrame([(p, k) for k, p in enumerate(patterns)], "pattern string, v int")
    before = len(session._written)
    got = lookups.pattern_join(df, F.col("s"), table, "pattern", ["v"], 100, 5)
    assert len(session._written) - before <= 9
    pairs = df.crossJoin(table).filter(F.expr("s RLIKE pattern")).select("i", "v")
    expected = df.select("i").join(pairs, "i", "left")
    assert sorted(map(str, got.select("i", "v").collect())) == sorted(map(str, expected.select("i", "v").collect()))


def test_literals_are_looked_up_at_their_edges(spark):
    """A text meets a pattern once for a whole word, not for each start of the word that is another pattern's."""
    from postlens.operators.pattern_index import literal_hits, numbered

    table = spark.createDataFrame([(rf"\border {k}\b",) for k in range(1, 1300)], "_pattern string")
    texts = spark.createDataFrame([(0, "line of order 1234, part 99"), (1, "reorder 12 border 7"), (2, "order 12")], "_row long, _text string")
    known, literals = numbered(table)
    hits = literal_hits(texts, literals).join(literals, "_key").join(known, "_id").select("_row", "_pattern").collect()
    assert sorted((r[0], r[1]) for r in hits) == [(0, r"\border 1234\b"), (2, r"\border 12\b")]


def test_fields_that_drift_are_rescued(spark, tmp_path):
    from postlens.sources.tables import read_rescued

    lines = ['{"id": 1, "name": "a", "extra": {"x": [1, 2]}}', '{"id": "7", "name": null}', '{"id": "seven", "name": 5}', "no json", "", "[1]", "{}"]
    (tmp_path / "l.json").write_text("\n".join(lines))
    schema = T._parse_datatype_string("id bigint, name string")
    got = read_rescued(spark, str(tmp_path), schema).select("id", "name", F.to_json("_rescued").alias("r")).collect()
    assert [tuple(r) for r in got] == [
        (1, "a", '{"extra":{"x":[1,2]}}'), (7, None, None), (None, "5", '{"id":"seven"}'), (None, None, '{"_line":"no json"}'),
        (None, None, '{"_line":""}'), (None, None, '{"_line":"[1]"}'), (None, None, None),
    ]
    assert read_rescued(spark, None, schema).columns == ["id", "name", "_rescued"] and read_rescued(spark, str(tmp_path / "none"), schema).isEmpty()


def test_required_literals():
    from postlens.functions.patterns import required_literals

    known = {
        "abc": ["abc"], "ab?c": None, "abc+d": ["abc"], "foo|bar": ["bar", "foo"], "a|bc": None, "(foo|bar)baz": ["bar", "foo"],
        "(foo)?baz": ["baz"], "[abc]de": ["de"], "x{2,}yz": ["yz"], "xy{0}zz": ["zz"], "(?iu)task": ["ta"], "(?i)Ab É": ["ab "],
        "(?:ab|cd)+ef": ["ab", "cd"], "a(?i)Bcd|EF": ["bcd", "ef"], r"p\.net": ["p.net"], r"q\p{L}rs": ["rs"], "(?x)a b": None, r"\Qab": None,
        "(?!ab)cde": ["cde"], "(ab": None, "[a-z&&[^b]]xy": ["xy"], "": None, r"\d+": None,
    }
    assert {p: required_literals(p) for p in known} == known


def test_dedupe_first_drops_empty_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("", 2), (None, 3), ("b", 4)], "k string, o int")
    assert rows(keys.dedupe_first(df, "k", "o"), "k") == [("a", 0), ("b", 4)]


def test_top_per_key_limits_before_the_shuffle(spark):
    plan = keys.top_per_key(spark.range(10).selectExpr("id % 2 AS k", "id"), ["k"], [F.col("id").desc()])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text


def test_rank_many_is_a_permutation_in_order(spark):
    df = spark.range(500).select("id", (F.col("id") * 7 % 13).alias("n"))
    got = rows(ranking.rank_many(df, [F.col("n").desc(), F.col("id").asc()], "r"), "r")
    assert [r[2] for r in got] == list(range(1, 501))
    assert [(r[1], r[0]) for r in got] == sorted(((n, i) for i, n, _ in got), key=lambda p: (-p[0], p[1]))


# ---- changes -------------------------------------------------------------------------------


def test_upsert_is_idempotent_and_keeps_untouched_columns(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "k string, v int, made string")
    batch = spark.createDataFrame([("b", 8, 1), ("b", 9, 2), ("c", 5, 1), (None, 1, 1)], "k string, v int, seq int")
    once = merge.upsert_latest(target, batch, "k", "seq", ["v"], {"made": F.lit("new")})
    assert rows(once, "k") == [("a", 1, "old"), ("b", 9, "old"), ("c", 5, "new")]
    assert rows(merge.upsert_latest(once, batch, "k", "seq", ["v"], {"made": F.lit("new")}), "k") == rows(once, "k")


def test_upsert_reads_target_and_changes_once(spark, tmp_path):
    spark.createDataFrame([("a", 1), (None, 2)], "k string, v int").write.parquet(str(tmp_path / "target"))
    spark.createDataFrame([("a", 5, 1), (None, 6, 1), ("b", 7, 1)], "k string, v int, seq int").write.parquet(str(tmp_path / "changes"))
    target, changes = spark.read.parquet(str(tmp_path / "target")), spark.read.parquet(str(tmp_path / "changes"))
    merged = merge.upsert_latest(target, changes, "k", "seq", ["v"])
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    assert sorted(rows(merged), key=str) == [("a", 5), ("b", 7), (None, 2)]
    assert rows(merge.without_key(changes, ["k"])) == [(None, 6, 1)]


def test_merges_write_one_row_per_key(spark):
    target = spark.createDataFrame([("a", 1), (None, 0)], "k string, v int")
    changes = spark.createDataFrame([("a", 3), ("a", 4), ("b", 8), ("b", 7), (None, 9)], "k string, v int")
    replaced = merge.merge_by_key(target, changes, ["k"], [F.col("v").desc()])
    assert sorted(rows(replaced), key=str) == [("a", 4), ("b", 8), (None, 0)]
    assert rows(merge.insert_absent(target, changes, ["k"])) == [("b", 7)]
    again = target.unionByName(merge.insert_absent(target, changes, ["k"]))
    assert rows(merge.insert_absent(again, changes, ["k"])) == []


def test_ties_are_broken_the_same_way(spark):
    made = [("a", 1, "x"), ("a", 1, "w"), ("a", 0, "z")]
    df = spark.createDataFrame(made, "k string, o int, v string")
    for copy in (df, df.orderBy("v"), df.orderBy(F.col("v").desc())):
        assert rows(keys.dedupe_last(copy, "k", "o")) == [("a", 1, "w")]


def test_high_water_mark(spark):
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    source = spark.createDataFrame([(x,) for x in t], "created_at timestamp")
    empty = spark.createDataFrame([], source.schema)
    target = source.filter(F.col("created_at") <= F.lit("2024-01-02").cast("timestamp"))
    assert merge.newer_than(source, None, "created_at").count() == 3
    assert merge.newer_than(source, empty, "created_at").count() == 3
    assert merge.newer_than(source, target, "created_at").count() == 1
    assert merge.newer_than(source, target, "created_at", inclusive=True).count() == 2


def test_delete_and_append(spark):
    history = spark.createDataFrame([], schemas.CHAT)
    new = spark.createDataFrame([("u", "user", "hi"), ("u", "assistant", "yo"), ("v", "user", "x")], "user_id string, role string, message string")
    history = merge.append_stamped(history, new)
    kept, deleted = merge.delete_by_key(history, F.col("user_id") == "u")
    assert deleted.first()[0] == 2 and kept.count() == 1 and history.filter("timestamp IS NULL").count() == 0


def test_mark_posted(spark):
    df = spark.createDataFrame([("a", False), ("b", True), ("c", False)], "url string, posted_to_discord boolean")
    sent = spark.createDataFrame([("a",), ("a",)], "url string")
    assert rows(merge.mark_posted(df, sent), "url") == [("a", True), ("b", True), ("c", False)]


def test_recent_rows(spark):
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    df = spark.createDataFrame(
        [("x", dt.datetime(2024, 1, 1, 11, 0)), ("x", dt.datetime(2024, 1, 1, 10, 59)), (" ", dt.datetime(2024, 1, 1, 12))],
        "embedding_text string, dbt_load_timestamp timestamp",
    )
    assert merge.recent_rows(df, now).count() == 1


# ---- landing and sources -------------------------------------------------------------------


def test_landing(spark, tmp_path):
    run = dt.datetime(2024, 5, 6, 7, 8, 9)
    empty = spark.createDataFrame([], schemas.CRAWL_A)
    assert tables.write_landing(empty, str(tmp_path), "board_a", run) is None
    assert tables.read_landing(spark, str(tmp_path / "none"), schemas.CRAWL_A).count() == 0
    assert tables.landing_path("/x/", "board_a", run) == "/x/board_a/board_a_20240506070809_jobs.json"
    (tmp_path / "array.json").write_text('[{"title": "a", "url": "u"}, {"title": "b"}]')
    got = tables.read_landing(spark, str(tmp_path / "array.json"), schemas.CRAWL_A, array_files=True)
    assert sorted(r["title"] for r in got.collect()) == ["a", "b"]


def test_source_list(spark):
    lists = spark.createDataFrame([("a", '{"x": "u1", "y": "u2"}'), ("a", "{broken"), ("b", '{"z": "u3"}')], "source string, content string")
    assert rows(tables.source_list(lists, "a", ("a", "b")), "name") == [("x", "u1"), ("y", "u2")]
    with pytest.raises(ValueError):
        tables.source_list(lists, "c", ("a", "b"))


# ---- quality -------------------------------------------------------------------------------


def records(spark, *values):
    return spark.createDataFrame(list(values), "url string, descriptions string, requirements string, experience string")


def test_quality_valid_and_invalid_batches(spark):
    good = records(spark, ("https://a", "d", "r", "1"), ("https://b", "d", "r", "2"))
    assert quality.require(good, quality.BOARD_A_CHECKS, "a") is good
    with pytest.raises(quality.QualityError, match="unique url.*"):
        quality.require(records(spark, ("https://a", "d", "r", "1"), ("https://a", "d", None, "1")), quality.BOARD_A_CHECKS, "a")
    quality.require(records(spark, ("https://a", "d", "r", "1"), ("http://b", "d", "r", "2")), quality.BOARD_B_CHECKS, "b")
    with pytest.raises(quality.QualityError, match="ftp://b"):
        quality.require(records(spark, ("https://a", "d", "r", "1"), ("ftp://b", "d", "r", None)), quality.BOARD_B_CHECKS, "b")
    with pytest.raises(quality.QualityError, match="no records"):
        quality.require(good.limit(0), quality.BOARD_A_CHECKS, "a")


def test_quality_samples_are_bounded(spark):
    many = spark.range(600).select(F.concat(F.lit("ftp://"), "id").alias("url"))
    got = {r["check"]: r for r in quality.run_checks(many, [quality.Check("row_count", high=500), quality.Check("matches", "url", "^https")]).collect()}
    assert got["row_count"]["failed"] == 1 and got["matches"]["failed"] == 600
    assert len(got["matches"]["sample"]) == fv.SAMPLE_VALUES
    unlimited = quality.run_checks(many, [quality.Check("row_count"), quality.Check("unique", "url")], samples=3).collect()
    assert [(r["failed"], r["sample"]) for r in unlimited] == [(0, []), (0, [])]
    twice = quality.run_checks(many.union(many), [quality.Check("unique", "url")], samples=3).first()
    assert (twice["failed"], twice["sample"]) == (1200, ["ftp://0", "ftp://1", "ftp://10"])


def test_model_checks_are_complete():
    checks = [c for model in quality.MODEL_CHECKS.values() for c in model]
    assert sum(c.kind == "unique" for c in checks) == 11 and sum(c.kind == "not_null" for c in checks) == 61


# ---- throttles -----------------------------------------------------------------------------


def brute(events, kind, limit, seconds):
    window = seconds * throttle.MICROS
    logs, fixed, out = {}, {}, {}
    for key, seq, at in sorted(events, key=lambda e: (e[0], e[2], e[1])):
        if kind == "sliding":
            log = [t for t in logs.get(key, []) if t > at - window]
            ok = len(log) < limit
            logs[key] = log + [at] if ok else log
            out[seq] = (ok, limit - len(logs[key]) if ok else 0, 0 if ok else max(1, int((window - (at - log[0])) / 1e6)))
        else:
            opened, count = fixed.get(key, (None, 0))
            if opened is None or at >= opened + window:
                opened, count = at, 0
            fixed[key] = (opened, count + 1)
            ok = count < limit
            left = int((opened + window - at) / 1e6 + 0.5)
            out[seq] = (ok, limit - count - 1 if ok else 0, 0 if ok else left if left > 0 else seconds)
    return out


@pytest.mark.parametrize("kind", ["fixed", "sliding"])
@pytest.mark.parametrize("seed", range(3))
def test_throttles_match_brute_force(spark, kind, seed):
    """One user is dense and never pauses, so that its windows run across many chunks."""
    rng = random.Random(seed)
    events, at = [], 0
    for seq in range(1500):
        at += rng.choice([0, 1, 3, 9, 20]) * throttle.MICROS + rng.randrange(1000)
        events.append(("hot" if seq % 3 else f"u{rng.randrange(5)}", seq, at + (rng.randrange(4) == 0) * 10**9))
    df = spark.createDataFrame(events, "user_id string, event_id bigint, at bigint").withColumn("ts", F.timestamp_micros("at"))
    if kind == "fixed":
        got = throttle.throttle_fixed(df, limit=4, seconds=60, chunk_seconds=60 + 30 * seed)
    else:
        got = throttle.throttle_sliding(df, limit=4, seconds=60)
    got = {r["event_id"]: (r["allowed"], r["remaining"], r["retry_after"]) for r in got.collect()}
    assert got == brute(events, kind, 4, 60)


def test_a_busy_key_is_cut_at_quiet_moments(spark):
    """A key that never pauses for a window, but slows down: its segments are more than one, its decisions the same."""
    gaps = ([1] * 30 + [40] * 4) * 12
    at = np.cumsum(gaps) * throttle.MICROS
    events = [("busy", i, int(t)) for i, t in enumerate(at)]
    df = spark.createDataFrame(events, "user_id string, event_id bigint, at bigint").withColumn("ts", F.timestamp_micros("at"))
    timed = df.select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), "at")
    segments = throttle.with_segment(timed, 60 * throttle.MICROS, 4)
    assert segments.select("segment").distinct().count() > 10
    assert segments.filter("NOT known").count() == len(events)
    got = {r["event_id"]: (r["allowed"], r["remaining"], r["retry_after"]) for r in throttle.throttle_sliding(df, limit=4, seconds=60).collect()}
    assert got == brute(events, "sliding", 4, 60)


@pytest.mark.parametrize("kind", ["fixed", "sliding"])
def test_throttle_denies_the_third_of_two(spark, kind):
    df = spark.createDataFrame([("u", i, dt.datetime(2024, 1, 1)) for i in range(3)], "user_id string, event_id int, ts timestamp")
    job = throttle.throttle_fixed if kind == "fixed" else throttle.throttle_sliding
    got = rows(job(df, limit=2, seconds=60).select("event_id", "allowed", "remaining", "retry_after"), "event_id")
    assert got == [(0, True, 1, 0), (1, True, 0, 0), (2, False, 0, 60)]


@pytest.mark.parametrize("kind, lateness", [("fixed", None), ("sliding", None), ("fixed", "1 minute"), ("sliding", "1 minute")])
def test_throttle_stream_keeps_state_between_batches(spark, tmp_path, kind, lateness):
    rng = random.Random(5)
    events = [(f"u{rng.randrange(3)}", i, (i + 1) * 7 * throttle.MICROS) for i in range(120)]
    for part in range(3):
        chunk = events[part * 40 : (part + 1) * 40]
        df = spark.createDataFrame(chunk, "user_id string, event_id bigint, at bigint")
        df.withColumn("ts", F.timestamp_micros("at")).drop("at").coalesce(1).write.parquet(str(tmp_path / "in" / f"p{part}"))
    schema = "user_id string, event_id bigint, ts timestamp"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "in" / "*"))
    decided = throttle_stream(stream, kind, limit=2, seconds=60, lateness=lateness)
    out = str(tmp_path / "out")
    decided.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(out).awaitTermination()
    got = {r["event_id"]: (r["allowed"], r["remaining"], r["retry_after"]) for r in spark.read.parquet(out).collect()}
    assert got == brute(events, kind, 2, 60)


# ---- vectors, chunks -----------------------------------------------------------------------


@pytest.mark.parametrize("block", [7, 1000])
def test_cosine_topk_matches_brute_force(spark, block):
    rng = np.random.default_rng(1)
    items, asks = rng.normal(size=(40, 8)), rng.normal(size=(15, 8))
    items[3] = items[4]  # a tie
    frame = lambda m, name: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], f"{name} bigint, embedding array<float>")
    got = vectors.cosine_topk(frame(asks, "query_id"), frame(items, "item_id"), 4, block_rows=block)
    unit = lambda m: (f := m.astype(np.float32).astype(float)) / np.linalg.norm(f, axis=1, keepdims=True)
    d = 1 - unit(asks) @ unit(items).T
    expected = [(q, i, round(d[q, i], 6)) for q in range(15) for i in sorted(range(40), key=lambda i: (round(d[q, i], 12), i))[:4]]
    assert rows(got.select("query_id", "item_id", "distance"), "query_id", "rank") == expected


def test_neighbours_are_ranked_by_the_whole_distance(spark):
    items = [(1, [1.0, 2e-4]), (2, [1.0, 1e-4]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (5, None), (6, [1.0]), (7, [1.0, None])]
    items = spark.createDataFrame(items, "item_id bigint, embedding array<double>")
    ask = spark.createDataFrame([(9, [1.0, 0.0]), (8, None)], "query_id bigint, embedding array<double>")
    got = vectors.cosine_topk(ask, items, 3)
    assert rows(got.select("query_id", "item_id"), "rank") == [(9, 3), (9, 2), (9, 1)]
    reasons = {r["item_id"]: r["reason"] for r in vectors.rejected_vectors(items, 2).collect()}
    assert reasons == {5: "no vector", 6: "another length", 7: "empty element"}


def test_embedder_is_pluggable(spark):
    import pandas as pd

    @F.pandas_udf("array<float>")
    def lengths(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [float(len(t))])

    df = spark.createDataFrame([("ab",), ("abc",)], "t string")
    assert [r["embedding"] for r in vectors.embed_text(df, "t", lengths).collect()] == [[2.0], [3.0]]
    assert all(len(r["embedding"]) == 256 for r in vectors.embed_text(df, "t").collect())


def parts_of(spark, text, limit):
    df = spark.createDataFrame([(text,)], "t string")
    return [r["chunk"] for r in chunks.chunk_text(df, "t", limit).orderBy("part").collect()]


def test_chunks(spark):
    assert [len(p) for p in parts_of(spark, "a" * 2500, 1000)] == [1000, 1000, 500]
    text = "\n".join("x" * n for n in (5, 4, 12, 3, 3))
    assert parts_of(spark, text, 10) == ["xxxxx\nxxxx", "x" * 10, "xx\nxxx\nxxx"]
    df = spark.createDataFrame([(1, text), (2, "s"), (3, None), (4, ""), (5, "\n" * 30)], "i int, t string")
    got = rows(chunks.chunk_text(df, "t", 10).filter("i > 1"), "i")
    assert got == [(2, 0, "s"), (3, None, None), (4, 0, ""), (5, None, None)]
    assert parts_of(spark, "\n\nab\r\ncd\x0b" + "é" * 9 + "\n", 8) == ["ab\ncd", "é" * 8, "é"]


# ---- pages ---------------------------------------------------------------------------------


def page(spark, html, url="https://x"):
    return spark.createDataFrame([(1, url, html)], "page_id bigint, url string, html string")


def test_page_urls(spark):
    df = spark.createDataFrame([("http://h/p?source=search_job&page=4",), ("http://h/?page=2&u_sr_id=abc",), ("http://h/a?q=a%20b&e#f",)], "u string")
    got = [r[0] for r in df.select(pages.page_url("u", F.lit(9))).collect()]
    assert got == ["http://h/p?source=search_job&page=9", "http://h/?u_sr_id=abc&page=9", "http://h/a?q=a+b&e=&page=9#f"]
    listed = pages.listing_pages(df.limit(1).select(F.col("u").alias("url"), F.lit(0).alias("n")), "n", 3)
    assert listed.count() == 1


def test_total_pages_and_last_page(spark):
    df = spark.createDataFrame([("1 / 200 trang",), ("1 / 1.200 trang",), ("none",), (None,)], "t string")
    assert [r[0] for r in df.select(pages.total_pages("t")).collect()] == [200, 1200, 1, 1]
    entries = ((" prev", 40), ("", 2), (" current", 3), (" gap", ".."), ("", 11), (" next", 50))
    bar = "".join(f'<div class="page{kind}"><a>{shown}</a></div>' for kind, shown in entries)
    html = f'<section class="pagination-search-jobs"><nav class="ipagination wide">{bar}</nav></section>'
    got = pages.page_text(page(spark, html)).first()
    assert got["last_page"] == 11 and pages.page_text(page(spark, "<p>x")).first()["last_page"] == 1


def test_page_text_and_challenges(spark):
    html = "<html><title> Just a moment </title><script>captcha</script><body><p> One </p><ul><li></li><li>two</li></ul></body>"
    got = pages.page_text(page(spark, html))
    signs = got.select(
        pages.is_challenge("title", "body", fv.CHALLENGE_SIGNS_A), pages.is_challenge(F.lit(""), F.lit("captcha"), fv.CHALLENGE_SIGNS_B)
    )
    assert tuple(got.first())[1:4] == ("Just a moment", "Just a moment One two", "One two")
    assert tuple(signs.first()) == (True, True)


def test_cards_of_both_boards(spark):
    a = """<div class="ipy-2"><h3 data-url="https://a/1?lab_feature=z"> Dev </h3><div class="imy-3 d-flex align-items-center">
      <img data-src="l.png"><span> Acme </span></div><div class="text-rich-grey flex-shrink-0">Hybrid</div>
      <div class="text-rich-grey text-truncate text-nowrap stretched-link position-relative" title="Ha Noi"></div>
      <div class="imt-4 imb-3 d-flex igap-1"><a>SQL</a><a> </a><a>Java</a></div></div><div class="ipy-2"><h3>ad</h3></div>"""
    got = pages.listing_cards(page(spark, a), pages.CARDS_A).collect()
    assert len(got) == 1
    assert got[0].asDict() == {
        "page_id": 1, "position": 0, "title": "Dev", "url": "https://a/1", "company": "Acme", "logo": "l.png",
        "mode": "Hybrid", "location": "Ha Noi", "tags": "SQL, Java",
    }
    b = """<div class="job-item-search-result"><img data-src="m.png"><a href="https://b/2?ta_source=q"><h3>BA</h3></a><a class="company">Co</a>
      <label class="address"><span>HCM</span></label><label class="salary">10 - 20</label><label class="exp"><span>2 năm</span></label></div>"""
    got = pages.listing_cards(page(spark, b), pages.CARDS_B).first().asDict()
    assert (got["url"], got["logo"], got["salary"], got["experience"]) == ("https://b/2", "m.png", "10 - 20", "2 năm")


def test_details_of_both_boards(spark):
    a = """<div>Job Expertise:</div><div><a>Data</a><a> ML </a></div><div class="imy-5 paragraph"><p>Do</p><li>it</li></div>
      <div class="imy-5 paragraph"><p>Know</p></div>"""
    got = pages.detail_fields(page(spark, a), pages.DETAIL_A).first().asDict()
    assert (got["job_cat"], got["descriptions"], got["requirements"]) == ("Data, ML", "Do it", "Know")
    b = """<div> Chuyên môn: </div><div><a>BA</a></div><div class="item"><h3>Mô tả công việc</h3>
      <div class="content"> <p>Do</p> </div></div><div class="item"><h3>Yêu cầu ứng viên</h3>
      <div class="content">Know</div></div><div><div class="title">Học vấn</div><div class="value">PhD</div></div>"""
    got = pages.detail_fields(page(spark, b), pages.DETAIL_B).first().asDict()
    assert (got["job_cat"], got["descriptions"], got["requirements"], got["education"]) == ("BA", "Do", "Know", "PhD")
    brand = """<div class="box"><h2 class="title">Mô tả công việc</h2><div class="tab">Do</div></div>
      <div class="box"><strong>Hình thức làm việc</strong><span>Full</span></div>"""
    got = pages.detail_fields(page(spark, brand), pages.DETAIL_B).first().asDict()
    assert (got["descriptions"], got["type_of_work"], got["education"]) == ("Do", "Full", None)


def test_elements_end_at_their_own_end_tags(spark):
    html = """<div class="imy-5 paragraph">Job <div>Build <b>tables</b></div> Write SQL</div></i>
      <div class="imy-5 paragraph"><ul><li>a<ul><li>b</li></ul>tail</li></ul><script>if (a</b) "</div>"</script><!-- </div> --> Need Spark</div> after"""
    got = pages.detail_fields(page(spark, html)).first()
    assert (got["descriptions"], got["requirements"], got["job_cat"]) == ("Job Build tables Write SQL", "a b tail Need Spark", None)
    assert pages.page_text(page(spark, html)).first()["paragraphs"] == "a b tail b"
    loose = pages.page_text(page(spark, "<p>one<p>two <i>x</i><ul><li>a<li>b<ul><li>c</ul></ul><p>three</p>")).first()
    assert loose["paragraphs"] == "one two x a b c a b c three" and loose["body"] == "one two x a b c three"
    odd = pages.page_text(page(spark, "a < b <3 <!-- open <p>x</p> <script>y <title>T")).first()
    assert (odd["title"], odd["paragraphs"], odd["body"]) == ("T", None, "a < b <3 x y T")  # the open comment ends at the next >
    empty = pages.page_text(page(spark, None)).first()
    assert (empty["title"], empty["body"], empty["paragraphs"]) == (None, "", None)


def test_attributes_and_steps():
    from postlens.operators.elements import Page, Read, Step

    tree = Page('<a HREF=x?1 data-k="v&amp;w" disabled><img src=""/></a><h3> Title </h3><div id=\'q\'>one<div>two</div></div><div>three')
    read = lambda *steps, **how: tree.read([Read(steps, **how)])
    assert read(Step(("a",)), attribute="href", until="?") == "x" and read(Step(("a",)), attribute="data-k") == "v&w"
    assert read(Step(("a",), having="disabled"), attribute="none") is None and read(Step(("img",)), attribute="src") is None
    assert read(Step(says="Title"), Step(("div",), after=True)) == "one two" and read(Step(("div",), holds="tw")) == "two"
    assert read(Step(("div",)), Step(("div",), after=True)) == "three" and read(Step(("div",)), Step(("div",))) == "two"
    assert tree.read([Read((Step(("h4",)),)), Read((Step(("h3",)),))]) == "Title"


def test_thousands_of_unclosed_tags_cost_no_more(spark):
    import time

    from postlens.operators.elements import Page, Read, Step

    for mark in ("<div class='x'>", "<p>", "<li>", "<script>", "<!--", "<a ", "</b>", "<b>", "<div>t</p>"):
        began, tree = time.time(), Page(mark * 30_000 + "end")
        tree.read([Read((Step(("div",), says="none"),)), Read((), each=("p", "li"))])
        assert time.time() - began < 5 and (mark == "<a " or tree.text().endswith("end"))


def test_a_page_of_unclosed_tags(spark):
    got = pages.page_text(page(spark, "<div>" * 5000 + "deep")).first()
    assert got["body"] == "deep"


# ---- assets --------------------------------------------------------------------------------


def test_assets(spark):
    png, jpeg = bytes.fromhex("89504E470D0A1A0A"), b"\xff\xd8\xff\xe0\x00\x10JFIF" + b"x" * 90
    df = spark.createDataFrame([("u1", bytearray(png)), ("u2", bytearray(jpeg)), ("u3", bytearray(b"??"))], "logo_url string, content binary")
    got = {r["logo_url"]: r for r in assets.store_logos(df).collect()}
    import base64
    import hashlib

    assert got["u1"]["object_name"] == f"logos/{hashlib.md5(b'u1').hexdigest()}.png"
    assert got["u2"]["logo_path"] == "data:image/jpeg;base64," + base64.b64encode(jpeg).decode()
    assert got["u3"]["status"] == "failed"
    assert assets.stored_or_raise(assets.store_logos(df)).count() == 2
    with pytest.raises(RuntimeError):
        assets.stored_or_raise(assets.store_logos(df.filter("logo_url = 'u3'")))


def test_lookup_patterns_are_tried_only_on_texts_with_their_literals(spark):
    texts = ["HÀ NỘI", "hà  nội", "Hanoi", "nội", "xx dn yy", "k", "Kelvin", "a'b", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    rows = [(r"(?iu)hà\s*nội|hanoi", "hn"), (r"\bdn\b", "dn"), ("(?iU)kelvin", "k"), ("a'b", "q"), (r"(.)\1", "twice"), ("^$", "empty")]
    got = lookups.regex_lookup(df, F.col("t"), rows, ["v"])
    expected = {(i, v) for i, t in enumerate(texts) for p, v in rows if t is not None and df.filter(F.col("id") == i).select(F.col("t").rlike(p)).first()[0]}
    found = [(r["id"], r["v"]) for r in got.collect()]
    assert {f for f in found if f[1] is not None} == expected and len(found) == len(set(found))
    assert {i for i, v in found if v is None} == set(range(len(texts))) - {i for i, _ in expected}
    screened = lookups.regex_lookup(df, F.col("t"), rows[:2], ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert screened.count("Contains(") >= 2


def test_values_are_looked_up_once_each(spark):
    from postlens.operators.lookups import per_value, rows_per_value

    df = spark.createDataFrame([(1, "a", "x"), (2, None, "=x"), (3, "", None), (3, "", None), (4, "a", "")], "id int, s string, t string")
    made = per_value(df, {"s": {"s": lambda c: F.upper(c)}, "t": {"n": lambda c: F.coalesce(F.length(c), F.lit(-1))}})
    expected = [(1, "x", "A", 1), (2, "=x", None, 2), (3, None, "", -1), (3, None, "", -1), (4, "", "A", 0)]
    assert made.columns == ["id", "t", "s", "n"] and sorted(map(tuple, made.collect()), key=str) == expected

    def step(values):  # none for "", two for "a", one for NULL
        assert values.count() == 3
        return values.withColumn("k", F.explode(F.expr("CASE WHEN s IS NULL THEN array(7) WHEN s = 'a' THEN array(1, 2) END")))

    got = rows_per_value(df, "s", step).select("id", "s", "k")
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a", 1), (1, "a", 2), (2, None, 7), (4, "a", 1), (4, "a", 2)]


def test_categories_and_cities_are_looked_up_on_written_values(spark):
    from postlens.plans import silver
    from postlens.plans.bronze import stg_board_a_jobs

    row = (1, "data engineer", "c", "l", "u", "x", "hà nội - hcm", "hybrid", "t", "d", "r", False, None)
    staging = spark.createDataFrame(
        [row, row],
        "id long, title string, company string, logo_url string, url string, job_category string, working_location string, "
        "work_model string, tags string, descriptions string, requirements_and_experiences string, "
        "posted_to_discord boolean, created_at timestamp",
    )
    jobs = silver.int_board_a_jobs(stg_board_a_jobs(staging))
    assert [r.job_category for r in jobs.collect()] == ["Data Engineer"] * 2
    assert any("/values-" in f for f in jobs.inputFiles())


def test_repeated_labels_are_capitalised_once_each(spark):
    """No capitals are worked out on the rows themselves, only on the written values; NULLs stay."""
    from postlens.plans.bronze import stg_board_b_jobs

    texts = ["title", "company", "logo_url", "url", "job_category", "working_location", "salary", "descriptions", "requirements", "experiences", "level_of_education", "work_model"]
    schema = "id long, " + ", ".join(f"{c} string" for c in texts) + ", posted_to_discord boolean, created_at timestamp"
    given = {"salary": " 1,000 usd", "level_of_education": "cao đẳng", "work_model": None, "title": "a-b"}
    staging = spark.createDataFrame([tuple([i, *[given.get(c, c) for c in texts], None, None]) for i in range(3)], schema)
    jobs = stg_board_b_jobs(staging)
    assert [(r.title, r.salary, r.level_of_education, r.work_model) for r in jobs.collect()] == [("A-B", "1000 Usd", "Cao Đẳng", None)] * 3
    plan = jobs._jdf.queryExecution().optimizedPlan().toString()
    above = [line for line in plan.splitlines() if "upper(" in line]
    assert above and not any("initcap" in line for line in above)


def test_salary_bounds_are_searched_only_where_their_words_are(spark):
    from postlens.functions import salary

    known = {"10 - 20 triệu": (10, 20), "Từ 7 triệu": (7, None), "TỚI 9": (None, 9), "upto  5": (None, 5), "Thoả thuận": (None, None), " 3-4": (3, 4), "từ 2 tới 6": (2, 6), None: (None, None)}
    df = spark.createDataFrame([(t,) for t in known], "s string").select("s", salary.min_salary("s").alias("a"), salary.max_salary("s").alias("b"))
    assert {r.s: (r.a and r.a // 10**6, r.b and r.b // 10**6) for r in df.collect()} == known
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Contains(") >= 6


def test_reports_write_only_what_gold_reads(spark, sf):
    from postlens.catalog import fixture as fx
    from postlens.plans import gold, silver

    jobs = fx.wanted_table(spark, sf, ids=False)
    assert "job_id" not in jobs.columns and "job_id" not in gold.fct_jobs(jobs).columns
    boards = fx.silver_a(spark, sf), fx.silver_b(spark, sf)
    plain = silver.int_jobs_unified(*boards, fx.logos(spark, sf))  # places found in the boards themselves
    counted = [df.groupBy("job_location", "job_category").count().collect() for df in (jobs, gold.categorised(plain))]
    assert sorted(counted[0], key=str) == sorted(counted[1], key=str) and all(r.job_category != "Others" for r in counted[0])


def test_texts_and_candidates_of_patterns_are_not_shuffled(spark):
    """The join of a long pattern table with its texts reads both from buckets."""
    texts = spark.createDataFrame([(i, f"line {i % 17} of {i}") for i in range(200)], "i int, s string")
    table = spark.createDataFrame([(rf"\bof {k}\b", k) for k in range(40)] + [(r"line \d$", -1)], "pattern string, v int")
    got = lookups.pattern_join(texts, F.col("s"), table, "pattern", ["v"], 5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert sorted(tuple(r) for r in got.filter("v IS NOT NULL").select("i", "v").collect()) == [(k, k) for k in range(40)]
    assert got.count() == 200
