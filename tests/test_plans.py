"""Models and retrieval on small inputs, and the gated build on the smallest driver tables."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens import fixed_values as fv
from postlens.catalog import fixture as fx
from postlens.operators import quality
from postlens.operators.vectors import embed_text
from postlens.plans import alerts, build, embedding, reports, retrieval
from postlens.sources import schemas, tables
from postlens.sources.buckets import BucketedTable
from postlens.streaming.ingest import ingest_stream


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ---- build ---------------------------------------------------------------------------------


def staged(spark, sf):
    once = lambda df: df.dropDuplicates(["url"])  # noqa: E731  one url repeats in the smallest tables
    return once(fx.staging_a(spark, sf)), once(fx.staging_b(spark, sf)), fx.logos(spark, sf)


def test_build_all_twice_adds_nothing_new(spark, sf, tmp_path):
    a, b, logos = staged(spark, sf)
    first = build.build_all(build.Store(spark, str(tmp_path), "1"), a, b, logos)
    assert set(quality.MODEL_CHECKS) - {"job_elt_summary", "task_performance"} <= set(first) | {"vector_db"}
    n = first["vector_db"].count()
    assert 0 < n == first["fct_jobs"].select("job_id").distinct().count()
    late = a.limit(1).withColumn("created_at", F.lit("2100-01-01").cast("timestamp_ntz")).withColumn("url", F.lit("https://new"))
    late = late.withColumn("title", F.lit("Data Analyst")).withColumn("working_location", F.lit("Hà Nội"))
    again = build.build_all(build.Store(spark, str(tmp_path), "2", "1"), a.unionByName(late), b, logos)
    assert again["stg_board_a_jobs"].count() == first["stg_board_a_jobs"].count() + 1
    assert again["vector_db"].count() == n + 1
    assert again["rpt_platform_comparison"].count() == 2


def test_build_stops_at_a_layer_that_fails(spark, sf, tmp_path):
    a, b, logos = staged(spark, sf)
    broken = a.withColumn("company", F.lit(None).cast("string"))
    with pytest.raises(quality.QualityError, match="stg_board_a_jobs"):
        build.build_all(build.Store(spark, str(tmp_path), "1"), broken, b, logos)
    assert not (tmp_path / "silver").exists()


def test_checks_are_counted_by_the_write(spark, tmp_path):
    """A table that passes is written by one job and not read for its row checks; a failure names its values."""
    checks = [quality.Check("row_count", high=3), quality.Check("not_null", "k"), quality.Check("matches", "k", "^a")]
    good = spark.createDataFrame([("a1",), ("a2",)], "k string")

    def jobs(tag, run):
        spark.sparkContext.setJobGroup(tag, tag)
        try:
            return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag))
        finally:
            spark.sparkContext.setJobGroup("other", "other")

    def write_checked(df, name, wanted):
        counted = quality.measured(df, wanted, name)
        counted.observed.write.parquet(str(tmp_path / name))
        return counted.require(spark.read.schema(df.schema).parquet(str(tmp_path / name)))

    written, n = jobs("checked", lambda: write_checked(good, "good", checks))
    assert n == 1 and written.count() == 2
    for name, rows_, wanted in (
        ("nulls", [("a",), (None,)], "not_null k"), ("wrong", [("a",), ("b",)], r"matches k .*'b'"), ("many", [("a",)] * 4, "row_count"),
        ("twice", [("a",), ("a",)], "unique k"), ("none", [], "no records"),
    ):
        with pytest.raises(quality.QualityError, match=wanted):
            write_checked(spark.createDataFrame(rows_, "k string"), name, [*checks, quality.Check("unique", "k")])


def test_tables_that_grow_keep_what_is_stored(spark, tmp_path):
    one, two = build.Store(spark, str(tmp_path), "1"), build.Store(spark, str(tmp_path), "02", "1")
    assert one.grown("l", "t") is None and one.append("l", "t", spark.range(3)).count() == 3
    stored = files_of(tmp_path / "l")
    for _ in range(2):  # a repeated run replaces its own rows
        assert two.grown("l", "t").count() == 3
        assert rows(two.append("l", "t", spark.range(3, 5)), "id") == [(i,) for i in range(5)]
    assert stored.items() <= files_of(tmp_path / "l").items()


def test_build_takes_its_mappings_from_seeds(spark, sf, tmp_path):
    a, b, logos = staged(spark, sf)
    (tmp_path / "job_category_mapping.csv").write_text('pattern,target_job_category\n(?i)\\bpower\\s*bi\\b,Charts\n"(data|""x""), none",None\n')
    (tmp_path / "vn_city_mapping.csv").write_text("pattern,city_code,city_en,region\nhcm|hà\\s*nội,big,Big City,any\n")
    mappings = tables.read_mappings(spark, str(tmp_path))
    assert [r[0] for r in mappings["job_category_mapping"].collect()] == [r"(?i)\bpower\s*bi\b", '(data|"x"), none']
    built = build.build_all(build.Store(spark, str(tmp_path / "out"), "1"), a, b, logos, mappings=mappings)
    jobs = built["int_jobs_unified"]
    assert {r[0] for r in jobs.select("job_category").distinct().collect()} == {"Charts", "Others"}
    assert {r[0] for r in jobs.select("job_location").distinct().collect()} == {"Big City", None}


def test_exact_quartiles_of_a_hot_key_lie_in_many_ranges(spark):
    rng = np.random.default_rng(9)
    values = [("hot", float(v)) for v in rng.normal(size=4000).round(3)] + [("b", 1.0)] * 3 + [("b", 2.0), ("n", None), (None, 5.0), (None, 7.0)]
    frame = spark.createDataFrame(values, "k string, v double").repartition(3)
    got = reports.exact_quartiles(frame, "k", "v", {"q1": 0.25, "q2": 0.5, "all": 1.0})
    hot = sorted(v for k, v in values if k == "hot")
    expected = {"hot": (hot[999], hot[1999], hot[-1]), "b": (1.0, 1.0, 2.0), None: (5.0, 5.0, 7.0)}
    assert {r["k"]: (r["q1"], r["q2"], r["all"]) for r in got.collect()} == expected
    assert reports.exact_quartiles(frame.limit(0), "k", "v", {"q": 0.5}).collect() == []


def test_sketched_quartiles_are_near_in_rank(spark):
    """The sketch of `rpt_salary_benchmark` is off by at most a ten-thousandth of the rows, in rank."""
    rng = np.random.default_rng(10)
    values = rng.permutation(40_000).astype(float)
    frame = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    found = frame.agg(F.percentile_approx("v", [0.25, 0.5, 0.75], 10_000)).first()[0]
    assert all(abs(v - f * 40_000) <= 40_000 / 10_000 + 1 for v, f in zip(found, (0.25, 0.5, 0.75)))


def test_salary_bounds_are_ordered(spark, sf):
    jobs = fx.fact(spark, sf).filter("salary_min_million IS NOT NULL AND salary_max_million IS NOT NULL")
    inside = F.col("salary_avg_million").between(F.col("salary_min_million"), F.col("salary_max_million"))
    assert jobs.filter(~inside).isEmpty() and not jobs.isEmpty()


# ---- embedding -----------------------------------------------------------------------------


def test_embed_accounting(spark):
    rows_ = [("a", "x", 1), (" a ", "y", 2), ("b", " ", 3), (None, "z", 4), ("c", "t", 5), ("d", "u", 6)]
    batch = spark.createDataFrame(rows_, "job_id string, embedding_text string, n int")
    known = spark.createDataFrame([("c",)], "job_id string")
    assert rows(embedding.embed_accounting(batch, known)) == [(6, 2, 1, 3)]
    picked = embedding.rows_to_embed(batch, known, F.col("n"))
    assert rows(picked, "job_id") == [("a", "x", 1), ("d", "u", 6)]
    assert rows(embedding.embed_accounting(batch.limit(0), known)) == [(0, 0, 0, 0)]


# ---- retrieval -----------------------------------------------------------------------------


def jobs_table(spark, values):
    """(job_id, salary text) rows with embeddings on a circle."""
    data = []
    for i, (job, salary) in enumerate(values):
        meta = {f: "" for f in fv.METADATA_FIELDS} | {"job_id": job, "job_title": f"T{job}", "salary": salary or "", "url": f"u{job}"}
        data.append((job, [float(np.cos(i / 9)), float(np.sin(i / 9))], salary, None, None, f"doc {job}", meta))
    meta_type = "struct<" + ",".join(f"{f}:string" for f in fv.METADATA_FIELDS) + ">"
    return spark.createDataFrame(
        data,
        "job_id string, embedding array<float>, salary string, salary_max_million string, salary_avg_million string, "
        f"document string, metadata {meta_type}",
    )


def test_salary_sort_puts_unknown_last(spark):
    df = spark.createDataFrame(
        [(0, "10 - 20 Triệu"), (1, "Thoả Thuận"), (2, "25 - 50 Triệu"), (3, None)], "n int, salary string"
    ).withColumns({"salary_max_million": F.lit(""), "salary_avg_million": F.lit("")})
    assert [r["n"] for r in retrieval.sort_by_salary(df, "n").collect()] == [2, 0, 1, 3]


def test_retrieve_search_sort_and_scan(spark):
    jobs = jobs_table(spark, [(f"j{i:02d}", None if i % 4 == 0 else f"{i} triệu") for i in range(30)])
    asks = spark.createDataFrame(
        [
            ("search", "kiếm job data", [1.0, 0.0], None),
            ("sorted", "3 job Python lương cao nhất", [1.0, 0.0], None),
            ("scan", "cho tôi 2 job lương cao nhất", [1.0, 0.0], None),
            ("many", "x", [0.0, 1.0], 20),
        ],
        "query_id string, message string, embedding array<float>, top_k int",
    )
    got = {}
    for r in retrieval.retrieve(asks, jobs, block_rows=8).orderBy("query_id", "position").collect():
        got.setdefault(r["query_id"], []).append((r["job_id"], r["retrieval_mode"]))
    assert [j for j, _ in got["search"]] == ["j00", "j01", "j02", "j03", "j04"]
    assert [j for j, _ in got["sorted"]] == ["j29", "j27", "j26"]
    assert got["scan"] == [("j29", "salary_collection_scan"), ("j27", "salary_collection_scan")]
    assert len(got["many"]) == fv.MAX_RESPONSE_LIMIT
    limited = retrieval.retrieve(asks.filter("query_id = 'scan'"), jobs, scan_limit=10).orderBy("position").collect()
    assert [r["job_id"] for r in limited] == ["j09", "j07"]


def test_result_records_and_links(spark):
    jobs = jobs_table(spark, [("a", "5 triệu"), ("b", None)]).withColumn("distance", F.lit(0.12))
    got = retrieval.result_records(jobs.select("job_id", "document", "metadata", "distance")).orderBy("job_id").collect()
    assert got[0]["title"] == "Ta" and got[0]["salary"] == "5 triệu" and got[0]["distance"] == 0.12 and got[0]["company"] == ""
    records = retrieval.result_records(jobs.select("job_id", "document", "metadata"))
    assert retrieval.source_links(records.withColumn("url", F.when(F.col("job_id") == "a", "u").otherwise(""))).count() == 1


def test_prompts(spark):
    ask = spark.createDataFrame([("q1", "u", "hello"), ("q2", "v", "any?")], "query_id string, user_id string, message string")
    results = retrieval.result_records(jobs_table(spark, [("a", "5"), ("b", "6")]).select("job_id", "document", "metadata"))
    results = results.withColumns({"query_id": F.lit("q1"), "position": F.when(F.col("job_id") == "a", 2).otherwise(1)})
    times = [dt.datetime(2024, 1, 1, 0, m) for m in range(4)]
    history = spark.createDataFrame([("u", "user", f"m{i}", t) for i, t in enumerate(times)], schemas.CHAT)
    prompts = dict(rows(retrieval.build_prompts(ask, results, retrieval.recent_messages(history, 2)).select("query_id", "prompt")))
    assert "user: m2\nuser: m3" in prompts["q1"] and "m1" not in prompts["q1"]
    assert prompts["q1"].index("[1] Tb") < prompts["q1"].index("[2] Ta")
    assert "No retrieved jobs." in prompts["q2"] and "No prior messages." in prompts["q2"] and "any?" in prompts["q2"]


def test_context_cuts_the_document_when_asked(spark):
    df = spark.createDataFrame([("q", 1, "x" * 2000)], "query_id string, position int, document string")
    df = df.withColumns({f: F.lit("") for f in fv.RESULT_FIELDS})
    context = retrieval.build_context(df, fv.CONTEXT_DOCUMENT_CHARS).first()["context"]
    assert context.startswith("[1] Untitled job\nCompany: ") and context.endswith("Content: " + "x" * 1200)
    assert retrieval.build_context(df).first()["context"].endswith("Content: " + "x" * 2000)


def test_result_lines_and_alerts(spark):
    df = spark.createDataFrame([(1, "Dev", "Acme", "https://x"), (11, "Late", "", "")], "position int, title string, company string, url string")
    df = df.withColumns({"salary": F.lit(""), "locations": F.lit(None).cast("string"), "experience_level": F.lit("Senior")})
    assert retrieval.result_lines(df).count() == 2
    got = retrieval.result_lines(df, n=fv.RESULT_LINES).collect()
    assert len(got) == 1
    assert got[0]["line"] == (
        "1. **Dev** - Acme\nSalary: Not specified\nLocation: Unknown location\nExperience: Senior\nLink: https://x"
    )
    jobs = spark.createDataFrame(
        [(" T ", "u", "", None, False, None), ("P", "v", "l", "x", True, "5")],
        "title string, url string, logo_url string, working_location string, posted_to_discord boolean, salary string",
    )
    assert rows(alerts.alert_records(alerts.pending_jobs(jobs))) == [("T", "u", None, None, "Negotiable")]


def test_retrieval_end_to_end_with_the_default_embedder(spark):
    jobs = jobs_table(spark, [("a", None), ("b", None)]).withColumn("document", F.when(F.col("job_id") == "a", "spark sql").otherwise("java"))
    jobs = embed_text(jobs.drop("embedding"), "document")
    asks = embed_text(spark.createDataFrame([("q", "sql with spark")], "query_id string, message string"), "message")
    assert retrieval.retrieve(asks, jobs).orderBy("position").first()["job_id"] == "a"


# ---- streaming -----------------------------------------------------------------------------


def replace_by_url(state, batch):
    return state.join(batch.select("url"), "url", "left_anti").unionByName(batch.dropDuplicates(["url"]))


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_ingest_stream_picks_up_new_files_only(spark, tmp_path):
    schema = T._parse_datatype_string("url string, v int")
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    table = BucketedTable(spark, str(tmp_path / "table"), schema, ["url"], 8)
    seen = []

    def apply(state, batch):
        seen.append(batch.count())
        return replace_by_url(state, batch)

    land = lambda *pairs: spark.createDataFrame(list(pairs), schema).coalesce(1).write.mode("append").json(landing)
    land(("a", 1), ("b", 1))
    assert ingest_stream(spark, landing, schema, table, checkpoint, apply) == len({r[0] for r in table._scan().select("_bucket").collect()})
    land(("b", 2))
    assert ingest_stream(spark, landing, schema, table, checkpoint, apply) == 1 and seen == [2, 1]
    assert rows(table.read(), "url") == [("a", 1), ("b", 2)]
    assert ingest_stream(spark, landing, schema, table, checkpoint, apply) == 0  # nothing new
    assert rows(table.read(), "url") == [("a", 1), ("b", 2)]


def test_repeated_records_of_several_batches_are_merged_once(spark, tmp_path):
    schema = T._parse_datatype_string("url string, at timestamp, v int")
    landing, checkpoint, merged = str(tmp_path / "landing"), str(tmp_path / "checkpoint"), []
    table = BucketedTable(spark, str(tmp_path / "table"), schema, ["url"], 4)

    def apply(state, batch):
        merged.extend(r["url"] for r in batch.collect())
        return replace_by_url(state, batch)

    day = lambda n: dt.datetime(2024, 1, n)
    for records in ([("a", day(1), 1), ("b", day(1), 1)], [("a", day(1), 1), ("c", day(2), 1)], [("b", day(1), 1), ("d", day(20), 1)], [("d", day(20), 1)]):
        spark.createDataFrame(records, schema).coalesce(1).write.mode("append").json(landing)
        ingest_stream(spark, landing, schema, table, checkpoint, apply, event_time="at", lateness="2 days")
    assert sorted(merged) == ["a", "b", "c", "d"] and table.read().count() == 4


def test_a_merge_writes_only_the_buckets_it_touches(spark, tmp_path):
    schema = T._parse_datatype_string("url string, v int")
    table = BucketedTable(spark, str(tmp_path / "table"), schema, ["url"], 32)
    table.create(spark.createDataFrame([(f"u{i}", i) for i in range(2000)], schema))
    before = files_of(tmp_path / "table")
    change = spark.createDataFrame([("u7", -1), ("u8", -2), ("new", -3)], schema)
    touched = table.merge(change, replace_by_url)
    after = files_of(tmp_path / "table")
    folders = lambda names: {n.split("/")[0] for n in names}
    assert 1 <= len(touched) <= 3 and folders(before.keys() ^ after.keys()) == {f"_bucket={b}" for b in touched}
    assert all(after[n] == t for n, t in before.items() if n in after) and len(after) == len(before)
    once = rows(table.read(), "url")
    table.merge(change, replace_by_url)
    assert rows(table.read(), "url") == once and len(once) == 2001 and len(files_of(tmp_path / "table")) == len(before)


def test_buckets_that_become_empty_and_wrong_steps(spark, tmp_path):
    schema = T._parse_datatype_string("url string, v int")
    table = BucketedTable(spark, str(tmp_path / "table"), schema, ["url"], 4)
    assert table.read().collect() == [] and table.merge(spark.createDataFrame([], schema), replace_by_url) == []
    table.merge(spark.createDataFrame([("a", 1), (None, 2)], schema), lambda state, new: state.unionByName(new))
    assert sorted(rows(table.read()), key=str) == [("a", 1), (None, 2)]
    table.merge(spark.createDataFrame([("a", 1)], schema), lambda state, new: state.join(new, "url", "left_anti"))
    assert rows(table.read()) == [(None, 2)]
    with pytest.raises(ValueError, match="not among"):
        table.merge(spark.createDataFrame([("a", 1)], schema), lambda state, new: spark.range(99).selectExpr("'k' || id AS url", "1 AS v"))



def test_tables_on_the_way_are_deleted(spark):
    """What a settled table was made of goes; the table itself and what others wrote stay."""
    from pathlib import Path

    from postlens import session

    other = session.materialise(spark.range(3), "other")
    inner = []

    def build():
        inner.append(session.materialise(spark.range(5), "inner"))
        return inner[0].withColumn("n", F.col("id") * 2)

    got = session.settled(spark, "outer", build)
    folder = lambda df: Path(df.inputFiles()[0].removeprefix("file:")).parent
    assert rows(got, "id") == [(i, 2 * i) for i in range(5)]
    assert folder(got).exists() and folder(other).exists() and not folder(inner[0]).exists()


def test_postings_are_written_once_for_all_model_tests(spark, sf, monkeypatch):
    from postlens.catalog import QUERIES

    written = []
    monkeypatch.setattr(fx, "settled", lambda spark, name, build: written.append(name) or build())
    assert len(QUERIES["quality_model_tests"](spark, sf).collect()) == 25
    assert written == ["postings"]


def test_texts_to_embed_are_laid_out_by_key(spark):
    """No shuffle of whole postings; any id is told apart, and ids that are held bring nothing."""
    from postlens.functions.text import packed_key, unpacked_key, surrogate_key

    ids = ["", "00", "0a", "0A", "0AF", "\x0100", "é", "AB" * 16, None]
    keys = spark.createDataFrame([(i,) for i in ids], "job_id string").withColumn("k", packed_key("job_id"))
    assert rows(keys.select("job_id", unpacked_key("k"))) == [(i, i) for i in ids]
    assert keys.select("k").distinct().count() == len(ids)
    columns = [c for c in embedding.MAX_COLUMNS if c not in ("job_title", "descriptions")]
    fact = spark.createDataFrame([(i, p, f"T{n}") for n, (i, p) in enumerate([("0a", "X"), ("0a", "Y"), ("0A", " "), ("é", None), (None, "Z")])], "job_id string, job_location string, job_title string")
    fact = fact.select("*", *[F.lit(None).cast("string").alias(c) for c in columns])
    jobs = spark.createDataFrame([("0a", "d1", None), ("0a", "d2", "r"), ("none", "d", "r"), (None, "dn", None)], "job_id string, descriptions string, requirements string")
    held = spark.createDataFrame([("0A",), ("other",), (None,)], "job_id string")
    got = embedding.vector_db(fact, jobs, held)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    assert sorted(map(str, got.select("job_id", "job_locations", "job_title").collect())) == sorted(
        map(str, spark.createDataFrame([("0a", "X, Y", "T1"), ("é", None, "T3"), (None, "Z", "T4")], "job_id string, job_locations string, job_title string").collect())
    )
    assert "d2" in got.filter("job_id = '0a'").first()["embedding_text"]


def test_models_that_do_not_read_each_other_are_built_side_by_side(spark, sf, tmp_path, monkeypatch):
    """Two reports meet at a barrier that neither passes alone; a failing one is raised after all have ended."""
    import threading

    a, b, logos = staged(spark, sf)
    barrier = threading.Barrier(2, timeout=120)

    def waits(report):
        return lambda *frames: (barrier.wait(), report(*frames))[1]

    monkeypatch.setattr(build, "FACT_REPORTS", {name: waits(report) for name, report in build.FACT_REPORTS.items()})
    built = build.build_all(build.Store(spark, str(tmp_path), "1"), a, b, logos)
    assert built["rpt_platform_comparison"].count() == 2


def test_repeated_values_are_found_by_their_hashes(spark, tmp_path):
    checks = [quality.Check("unique", "k")]

    def gate(tag, values):
        counted = quality.measured(spark.createDataFrame([(v,) for v in values], "k string"), checks, tag)
        counted.observed.write.parquet(f"{tmp_path}/{tag}")
        return counted.require(spark.read.parquet(f"{tmp_path}/{tag}"))

    assert gate("once", ["a", "b", None, None]).count() == 4
    with pytest.raises(quality.QualityError, match="unique k"):
        gate("twice", ["a", "b", "a"])
