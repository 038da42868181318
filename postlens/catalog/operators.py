"""Tables, changes, joins, aggregates, windows and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens import fixed_values as fv
from postlens.catalog import fixture as fx
from postlens.catalog.fixture import with_ctes
from postlens.catalog.registry import query, table
from postlens.functions.text import text_or_empty
from postlens.operators import keys, merge, ranking
from postlens.plans import reports, silver
from postlens.session import fresh_path
from postlens.sources import schemas, tables

RUN = dt.datetime(2024, 1, 1, 8, 30)
SUPPLIER_LOGO = "concat('https://img.example/', cast(s_suppkey AS varchar(30)), '.png')"

# ---- sources, sinks, table writes ----------------------------------------------------------

CRAWL_COLUMNS = "s_name AS title, 'Acme' AS company, " + SUPPLIER_LOGO + " AS logo, " + SUPPLIER_LOGO + " AS url"


def _crawl(spark, sf_dir):
    """Suppliers as crawl records of board A, with fields nobody filled in."""
    known = table(spark, sf_dir, "supplier").selectExpr(
        "s_name AS title", "'Acme' AS company", f"{SUPPLIER_LOGO} AS logo", f"{SUPPLIER_LOGO} AS url"
    )
    filled = known.columns
    empty = [F.lit(None).cast("string").alias(f.name) for f in schemas.CRAWL_A if f.name not in filled]
    return known.select("*", *empty).select(*schemas.CRAWL_A.names)


CRAWL_SQL = f"""SELECT {CRAWL_COLUMNS}, NULL::VARCHAR AS job_cat, NULL::VARCHAR AS location, NULL::VARCHAR AS mode,
  NULL::VARCHAR AS tags, NULL::VARCHAR AS descriptions, NULL::VARCHAR AS requirements FROM supplier"""


@query("landing_roundtrip", CRAWL_SQL)
def landing_roundtrip(spark, sf_dir):
    base = fresh_path(spark, "landing")
    path = tables.write_landing(_crawl(spark, sf_dir), base, "board_a", RUN)
    return tables.read_landing(spark, path, schemas.CRAWL_A)


@query(
    "landing_rescue",
    """SELECT s_suppkey::BIGINT AS id, s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_nationkey::INTEGER END AS code,
         CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal::DOUBLE END AS rescued_balance,
         CASE WHEN s_suppkey % 3 = 0 THEN concat('n', s_nationkey::VARCHAR) END AS rescued_code FROM supplier""",
)
def landing_rescue(spark, sf_dir):
    """Records some of which have a field the schema does not know, or text where it has a number."""
    suppliers = table(spark, sf_dir, "supplier")
    known = (F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    balance = F.when(F.col("s_suppkey") % 2 == 0, F.col("s_acctbal").cast("double")).alias("balance")
    typed = F.to_json(F.struct(*known, balance, F.col("s_nationkey").alias("code")))
    drifted = F.to_json(F.struct(*known, balance, F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("code")))
    landing = fresh_path(spark, "landing")
    suppliers.select(F.when(F.col("s_suppkey") % 3 == 0, drifted).otherwise(typed).alias("value")).write.text(landing)
    schema = T._parse_datatype_string("id bigint, name string, code int")
    read = tables.read_rescued(spark, landing, schema)
    return read.select(
        "id", "name", "code",
        F.try_variant_get("_rescued", "$.balance", "double").alias("rescued_balance"),
        F.try_variant_get("_rescued", "$.code", "string").alias("rescued_code"),
    )


@query("seed_load", "SELECT n_name AS pattern, n_nationkey AS code FROM nation")
def seed_load(spark, sf_dir):
    path = fresh_path(spark, "seed")
    nation = table(spark, sf_dir, "nation").select(F.col("n_name").alias("pattern"), F.col("n_nationkey").alias("code"))
    nation.write.option("header", True).csv(path)
    return tables.read_seed(spark, path, "pattern string, code int")


@query("source_list", "SELECT url AS name, concat('https://lists.example/', page_id::VARCHAR) AS url FROM pages")
def source_list(spark, sf_dir):
    """Each page row is one JSON object name -> url."""
    pages = table(spark, sf_dir, "pages")
    url = F.concat(F.lit("https://lists.example/"), F.col("page_id").cast("string"))
    lists = pages.select(F.lit("board_a").alias("source"), F.to_json(F.create_map("url", url)).alias("content"))
    return tables.source_list(lists, "board_a", ("board_a", "board_b"))


@query("scan_tables", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 30 GROUP BY l_returnflag")
def scan_tables(spark, sf_dir):
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("staging_lineitem")
    scan = tables.read_table(spark, "staging_lineitem").filter("l_quantity > 30")
    return scan.groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("full_refresh", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def full_refresh(spark, sf_dir):
    """Two refreshes of one table: the second replaces the first."""
    path = fresh_path(spark, "refresh")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    for version in (joined.limit(0), joined):
        version.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("layer_tables", "SELECT s_suppkey, s_name FROM supplier")
def layer_tables(spark, sf_dir):
    """A table written into its own layer and read back by name."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return tables.write_layer(suppliers, "suppliers", " bronze ", path=fresh_path(spark, "layer"))


@query(
    "rename_projection",
    f"""SELECT title, company, logo AS logo_url, url, job_cat AS job_category, location AS working_location,
        mode AS work_model, tags, descriptions, requirements AS requirements_and_experiences FROM ({CRAWL_SQL})""",
)
def rename_projection(spark, sf_dir):
    return tables.rename_crawl(_crawl(spark, sf_dir), schemas.RENAME_A)


@query(
    "append_rows",
    """SELECT conv_id::VARCHAR AS user_id, role, text AS message, TIMESTAMP '2024-01-01 00:00:00' AS timestamp
       FROM conversations""",
)
def append_rows(spark, sf_dir):
    """A chat history that receives its messages."""
    talk = table(spark, sf_dir, "conversations")
    rows = talk.select(F.col("conv_id").cast("string").alias("user_id"), "role", F.col("text").alias("message"))
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    out = merge.append_stamped(spark.createDataFrame([], schemas.CHAT), rows, now)
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(
    "hex_binary",
    """SELECT p_partkey, lower(hex(encode(p_name))) AS name_hex, coalesce(p_brand, '') AS brand, 'Full-time' AS kind,
       NULL::VARCHAR AS salary, coalesce(p_size::VARCHAR, '') AS size FROM part""",
)
def hex_binary(spark, sf_dir):
    from postlens.functions.text import hex_text

    part = table(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        hex_text(F.encode("p_name", "UTF-8")).alias("name_hex"),
        text_or_empty("p_brand").alias("brand"),
        F.lit("Full-time").alias("kind"),
        F.lit(None).cast("string").alias("salary"),
        text_or_empty("p_size").alias("size"),
    )


# ---- windows -------------------------------------------------------------------------------


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
       ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def latest_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()]
    return keys.top_per_key(orders, ["o_custkey"], order).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "rank_over_aggregate",
    """SELECT o_custkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, o_custkey) AS customer_rank
       FROM orders GROUP BY o_custkey""",
)
def rank_over_aggregate(spark, sf_dir):
    counted = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return ranking.rank_many(counted, [F.col("n").desc(), F.col("o_custkey").asc()], "customer_rank")


PAID = "CASE WHEN o_orderstatus = 'F' THEN o_totalprice END"


@query(
    "rank_nulls_last",
    f"""SELECT c_nationkey, round(avg({PAID}), 2) AS mean, row_number() OVER (ORDER BY avg({PAID}) DESC NULLS LAST,
        c_nationkey) AS price_rank FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_nationkey""",
)
def rank_nulls_last(spark, sf_dir):
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    joined = customer.join(orders, customer.c_custkey == orders.o_custkey, "left")
    rows = joined.groupBy("c_nationkey").agg(F.avg(F.expr(PAID)).alias("_mean"))
    ranked = ranking.rank_few(rows, [F.col("_mean").desc_nulls_last(), F.col("c_nationkey").asc()], "price_rank")
    return ranked.select("c_nationkey", F.round("_mean", 2).alias("mean"), "price_rank")


@query(
    "market_mean_delta",
    """SELECT *, CASE WHEN d > 0 THEN 'Above Average' WHEN d < 0 THEN 'Below Average' ELSE 'At Market' END AS position
       FROM (SELECT c_mktsegment, round(avg(c_acctbal), 2) AS mean, round(avg(avg(c_acctbal)) OVER (), 2) AS market,
       round(avg(c_acctbal) - avg(avg(c_acctbal)) OVER (), 2) AS d FROM customer GROUP BY c_mktsegment)""",
)
def market_mean_delta(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("_mean"))
    rows = rows.withColumn("_market", rows.agg(F.avg("_mean")).scalar())
    rows = rows.withColumn("d", F.round(F.col("_mean") - F.col("_market"), 2))
    position = F.when(F.col("d") > 0, "Above Average").when(F.col("d") < 0, "Below Average").otherwise("At Market")
    return rows.select(
        "c_mktsegment", F.round("_mean", 2).alias("mean"), F.round("_market", 2).alias("market"), "d",
        position.alias("position"),
    )


# ---- aggregates ----------------------------------------------------------------------------


@query(
    "counts_and_sums",
    """SELECT l_returnflag, count(*) AS n, count(CASE WHEN l_tax > 0 THEN 1 END) AS taxed,
       sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)::BIGINT AS open_lines, round(sum(l_quantity), 2) AS quantity,
       round(avg(l_extendedprice), 2) AS mean_price, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
       FROM lineitem GROUP BY l_returnflag""",
)
def counts_and_sums(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("l_tax") > 0, 1)).alias("taxed"),
        F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
        F.round(F.sum("l_quantity"), 2).alias("quantity"),
        F.round(F.avg("l_extendedprice"), 2).alias("mean_price"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query(
    "distinct_conditional",
    """SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_suppkey) AS suppliers,
       count(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_orderkey END) AS open_orders FROM lineitem GROUP BY l_returnflag""",
)
def distinct_conditional(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        reports.distinct("l_orderkey").alias("orders"),
        reports.distinct("l_suppkey").alias("suppliers"),
        reports.distinct("l_orderkey", "l_linestatus = 'O'").alias("open_orders"),
    )


@query("max_collapse", "SELECT l_orderkey, max(l_returnflag) AS flag, max(l_shipdate) AS ship FROM lineitem GROUP BY 1")
def max_collapse(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_orderkey").agg(F.max("l_returnflag").alias("flag"), F.max("l_shipdate").alias("ship"))


@query(
    "join_strings",
    """SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority)
       FILTER (WHERE o_orderstatus = 'F') AS priorities FROM orders GROUP BY o_custkey""",
)
def join_strings(spark, sf_dir):
    finished = table(spark, sf_dir, "orders").select(
        "o_custkey", F.expr("CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END").alias("p")
    )
    return finished.groupBy("o_custkey").agg(reports.joined_values("p").alias("priorities"))


@query(
    "share_of_total",
    """SELECT c_mktsegment, round(100.0 * count(*) / nullif((SELECT count(*) FROM customer), 0), 2) AS pct
       FROM customer GROUP BY c_mktsegment""",
)
def share_of_total(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    rows = customer.groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    total = customer.agg(F.count("*")).scalar()
    return rows.select("c_mktsegment", reports.percent(F.col("n"), total).alias("pct"))


@query(
    "success_rate",
    """SELECT event_type, round(100.0 * sum(CASE WHEN value > 20 THEN 1 ELSE 0 END) / count(*), 2) AS rate
       FROM events GROUP BY event_type""",
)
def success_rate(spark, sf_dir):
    rate = reports.percent(F.count_if(F.col("value") > 20), F.count("*"))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(rate.alias("rate"))


@query("group_by_date", "SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1")
def group_by_date(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))


@query(
    "quartiles",
    """SELECT l_returnflag, quantile_disc(l_quantity, 0.25) AS q1, quantile_disc(l_quantity, 0.5) AS q2,
       quantile_disc(l_quantity, 0.75) AS q3 FROM lineitem GROUP BY l_returnflag""",
)
def quartiles(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return reports.exact_quartiles(lines, "l_returnflag", "l_quantity", {"q1": 0.25, "q2": 0.5, "q3": 0.75})


@query("distinct_rows", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()


@query(
    "days_range",
    """SELECT o_custkey, date_diff('day', min(o_orderdate)::DATE, max(o_orderdate)::DATE) + 1 AS days
       FROM orders GROUP BY o_custkey""",
)
def days_range(spark, sf_dir):
    day = F.to_date("o_orderdate")
    days = (F.date_diff(F.max(day), F.min(day)) + 1).cast("bigint")
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(days.alias("days"))


# ---- set operations and joins --------------------------------------------------------------


@query(
    "union_all_sources",
    with_ctes("SELECT url, title FROM staging_a UNION ALL SELECT url, title FROM staging_b", "staging_b"),
)
def union_all_sources(spark, sf_dir):
    halves = [f(spark, sf_dir).select("url", "title") for f in (fx.staging_a, fx.staging_b)]
    return halves[0].unionByName(halves[1])


@query(
    "union_distinct",
    """SELECT s_nationkey AS nation FROM supplier WHERE s_acctbal > 0
       UNION SELECT c_nationkey FROM customer WHERE c_acctbal > 0""",
)
def union_distinct(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(F.col("s_nationkey").alias("nation"))
    c = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select("c_nationkey")
    return s.distinct().union(c.distinct()).distinct()


@query(
    "star_left_join",
    """SELECT n_nationkey, n_name, count(c_custkey) AS customers, count(DISTINCT c_mktsegment) AS segments
       FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY n_nationkey, n_name""",
)
def star_left_join(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    measures = (F.count("c_custkey").alias("customers"), reports.distinct("c_mktsegment").alias("segments"))
    return reports.per_member(nation, customer, "n_nationkey", *measures, counts=("customers", "segments"))


@query(
    "join_preaggregated",
    """SELECT c_custkey, last_order FROM customer
       LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def join_preaggregated(spark, sf_dir):
    latest = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    return customer.join(latest, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "last_order")


TITLE = with_ctes(
    """SELECT b.url, m.target AS category FROM postings b
       LEFT JOIN (SELECT * FROM (VALUES {rows}) t(pattern, target)) m ON regexp_matches(lower(b.title), m.pattern)""",
    "postings",
).replace("{rows}", fx._values(fv.CATEGORY_PATTERNS))


@query("category_regex_join", TITLE.replace("m.target AS", "coalesce(m.target, 'Others') AS"))
def category_regex_join(spark, sf_dir):
    jobs = silver.with_category(fx.postings(spark, sf_dir).select("url", "title"))
    return jobs.select("url", F.col("job_category").alias("category"))


@query("category_seed_join", TITLE.replace("m.target AS", "coalesce(m.target, 'Others') AS"))
def category_seed_join(spark, sf_dir):
    """The categories from a seed file, as the build reads it."""
    jobs = silver.with_category(fx.postings(spark, sf_dir).select("url", "title"), patterns=_seeds(spark)["job_category_mapping"])
    return jobs.select("url", F.col("job_category").alias("category"))


def _seeds(spark):
    """The mapping seeds, written as files and read back."""
    folder = fresh_path(spark, "mappings")
    for name, rows in (("job_category_mapping", fv.CATEGORY_PATTERNS), ("vn_city_mapping", fv.CITY_PATTERNS)):
        seed = spark.createDataFrame([tuple(r) for r in rows], tables.SEEDS[name])
        seed.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}.csv")
    return tables.read_mappings(spark, folder)


# A pattern for each order and part, one without a literal, and one that matches nothing.
PATTERNS = r"""SELECT concat('\\border ', cast(o_orderkey AS varchar(30)), '\\b') AS pattern, o_orderpriority AS label FROM orders
UNION ALL SELECT concat('(?i)PART (no )?0*', cast(p_partkey AS varchar(30)), '$'), p_brand FROM part
UNION ALL SELECT '[5-7] of', 'late line' FROM region WHERE r_regionkey = 0
UNION ALL SELECT 'order x', 'none' FROM region WHERE r_regionkey = 0"""
SHIPPED = """SELECT concat('line ', cast(l_linenumber AS varchar(9)), ' of order ', cast(l_orderkey AS varchar(30)), ', part ',
  cast(l_partkey AS varchar(30))) AS shipped FROM lineitem"""


@query(
    "pattern_table_join",
    f"""WITH shipments AS ({SHIPPED.replace(" AS shipped", " AS shipped, l_orderkey, l_partkey, l_linenumber")})
        SELECT shipped, o_orderpriority AS label FROM shipments JOIN orders ON l_orderkey = o_orderkey
        UNION ALL SELECT shipped, p_brand FROM shipments JOIN part ON l_partkey = p_partkey
        UNION ALL SELECT shipped, 'late line' FROM shipments WHERE l_linenumber BETWEEN 5 AND 7""",
)
def pattern_table_join(spark, sf_dir):
    """Lines against a table of a pattern per order and part: 17,000 patterns at scale 0.01, 170,000 at 0.1."""
    from postlens.operators.lookups import pattern_join

    names = ("orders", "part", "region")
    sql = PATTERNS
    for name in names:
        sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}")
    patterns = spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})
    shipments = spark.sql(SHIPPED.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))
    return pattern_join(shipments, F.col("shipped"), patterns, "pattern", ["label"])


PLACES = """SELECT url, trim(place) AS place FROM (SELECT url, unnest(string_split(
  trim(replace(replace(lower(working_location), '(mới)', ''), '&', '-')), '-')) AS place FROM postings)
  WHERE place NOT LIKE '%nơi khác%'"""


def _places(spark, sf_dir):
    from postlens.functions.text import normal_location

    jobs = fx.postings(spark, sf_dir).select("url", normal_location("working_location").alias("place"))
    return silver.split_locations(jobs, "place")


@query("location_explode", with_ctes(PLACES, "postings"))
def location_explode(spark, sf_dir):
    return _places(spark, sf_dir)


@query(
    "city_regex_join",
    with_ctes(
        f"""SELECT p.url, p.place, c.city_en FROM ({PLACES}) p
            LEFT JOIN (SELECT * FROM (VALUES {fx._values(fv.CITY_PATTERNS)}) t(pattern, city_code, city_en, region)) c
            ON regexp_matches(p.place, c.pattern)""",
        "postings",
    ),
)
def city_regex_join(spark, sf_dir):
    return silver.with_city(_places(spark, sf_dir), "place")


@query(
    "logo_left_join",
    with_ctes("SELECT p.url, l.logo_id FROM postings p LEFT JOIN logos l ON p.logo_url = l.logo_url", "logos"),
)
def logo_left_join(spark, sf_dir):
    from postlens.operators.lookups import lookup_join

    jobs = fx.postings(spark, sf_dir).select("url", "logo_url")
    known = fx.logos(spark, sf_dir).select("logo_url", "logo_id")
    return lookup_join(jobs, known, "logo_url").select("url", "logo_id")


@query(
    "new_logo_anti",
    with_ctes(
        """SELECT md5(n.logo_url) AS logo_id, n.logo_url FROM
           (SELECT logo_url FROM staging_a WHERE logo_url <> '' UNION SELECT logo_url FROM staging_b WHERE logo_url <> '') n
           LEFT JOIN logos l ON n.logo_url = l.logo_url WHERE l.logo_url IS NULL""",
        "logos",
    ),
)
def new_logo_anti(spark, sf_dir):
    boards = [fx.staging_a(spark, sf_dir), fx.staging_b(spark, sf_dir)]
    return merge.new_logos(boards, fx.logos(spark, sf_dir))


@query(
    "update_logos",
    f"""SELECT CASE WHEN s_acctbal > 0 THEN md5({SUPPLIER_LOGO}) ELSE s_name END AS logo_id, {SUPPLIER_LOGO} AS logo_url,
        CASE WHEN s_acctbal > 0 THEN s_name END AS logo_path, s_acctbal > 0 AS is_downloaded,
        CASE WHEN s_acctbal > 0 THEN DATE '2024-01-02' END AS updated_on FROM supplier""",
)
def update_logos(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").withColumn("logo_url", F.expr(SUPPLIER_LOGO))
    known = supplier.select(
        F.col("s_name").alias("logo_id"),
        "logo_url",
        F.lit(None).cast("string").alias("logo_path"),
        F.lit(False).alias("is_downloaded"),
        F.lit("2024-01-01").cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )
    done = supplier.filter("s_acctbal > 0").select("logo_url", F.col("s_name").alias("logo_path"))
    out = merge.update_logos(known, done, F.lit("2024-01-02").cast("timestamp"))
    return out.select("logo_id", "logo_url", "logo_path", "is_downloaded", F.to_date("updated_at").alias("updated_on"))


@query(
    "not_exists_new",
    """SELECT c_custkey, c_name FROM customer c
       WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')""",
)
def not_exists_new(spark, sf_dir):
    target = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return merge.insert_absent(target, table(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_custkey"])


@query(
    "mark_posted",
    with_ctes(
        "SELECT url, posted_to_discord OR coalesce(salary LIKE 'Từ%', false) AS posted_to_discord FROM postings", "postings"
    ),
)
def mark_posted(spark, sf_dir):
    jobs = fx.postings(spark, sf_dir)
    sent = jobs.filter("salary LIKE 'Từ%'").select("url")
    return merge.mark_posted(jobs.select("url", "posted_to_discord"), sent)


# ---- changes -------------------------------------------------------------------------------

DELTA = """SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, 'X' AS o_orderstatus, o_orderdate FROM orders
  WHERE o_orderpriority LIKE '1%' OR o_orderstatus = 'P'"""


def _target(spark, sf_dir):
    """Orders already loaded: everything that is not pending."""
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    return orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")


def _delta(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_orderpriority LIKE '1%' OR o_orderstatus = 'P'")
    return orders.select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit("X").alias("o_orderstatus"), "o_orderdate"
    )


@query(
    "upsert_latest",
    f"""SELECT o_orderkey, coalesce(d.o_totalprice, t.o_totalprice) AS o_totalprice,
        CASE WHEN t.o_orderkey IS NULL THEN 'new' ELSE t.o_orderstatus END AS o_orderstatus,
        CASE WHEN t.o_orderkey IS NULL THEN d.o_orderdate ELSE t.o_orderdate END AS o_orderdate
        FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P') t FULL JOIN ({DELTA}) d USING (o_orderkey)""",
)
def upsert_latest(spark, sf_dir):
    """Only the price changes on known keys; the batch repeats every key and its last record wins."""
    batch = _delta(spark, sf_dir).withColumn("seq", F.lit(2))
    stale = batch.withColumn("seq", F.lit(1)).withColumn("o_totalprice", F.lit(0.0))
    return merge.upsert_latest(
        _target(spark, sf_dir), stale.unionByName(batch), "o_orderkey", "seq", ["o_totalprice"],
        {"o_orderstatus": F.lit("new")},
    )


@query(
    "merge_incremental",
    """SELECT o_orderkey, o_totalprice + CASE WHEN o_orderdate > (SELECT max(o_orderdate) FROM orders
         WHERE o_orderpriority LIKE '1%') THEN 1 ELSE 0 END AS o_totalprice, o_orderdate FROM orders
       WHERE o_orderpriority LIKE '1%' OR o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderpriority LIKE '1%')""",
)
def merge_incremental(spark, sf_dir):
    """Urgent orders are loaded; of the others only those above the high-water mark arrive."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    target = orders.filter("o_orderpriority LIKE '1%'").drop("o_orderpriority")
    source = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1).drop("o_orderpriority")
    return merge.merge_by_key(target, merge.newer_than(source, target, "o_orderdate"), ["o_orderkey"])


@query("insert_only", "SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def insert_only(spark, sf_dir):
    return merge.insert_absent(_target(spark, sf_dir), _delta(spark, sf_dir), ["o_orderkey"]).select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "delete_by_key",
    """SELECT conv_id, turn, (SELECT count(*) FROM conversations WHERE role = 'system') AS deleted
       FROM conversations WHERE role <> 'system'""",
)
def delete_by_key(spark, sf_dir):
    kept, deleted = merge.delete_by_key(table(spark, sf_dir, "conversations"), F.col("role") == "system")
    return kept.select("conv_id", "turn", deleted.scalar().alias("deleted"))


@query(
    "dedupe_first",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id)
       AS rn FROM events) WHERE rn = 1""",
)
def dedupe_first(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("user_id", F.col("user_id").cast("string"))
    first = keys.dedupe_first(events, "user_id", "event_id")
    return first.select(F.col("user_id").cast("bigint").alias("user_id"), "event_id", "event_type")


@query(
    "recent_window",
    """SELECT event_id, event_type FROM events
       WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR AND trim(event_type) <> ''""",
)
def recent_window(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    latest = events.agg(F.max("ts")).scalar()
    return merge.recent_rows(events, latest, 1, "event_type", "ts").select("event_id", "event_type")


@query(
    "batch_caps",
    """SELECT lang, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents)
       WHERE rn <= 100""",
)
def batch_caps(spark, sf_dir):
    """At most 100 records per source, in order: the cap of a crawl batch."""
    documents = table(spark, sf_dir, "documents").select("lang", "doc_id")
    return keys.top_per_key(documents, ["lang"], [F.col("doc_id").asc()], 100)


# ---- filters -------------------------------------------------------------------------------


@query(
    "filters_category",
    with_ctes(
        """SELECT url, job_category FROM silver_a WHERE job_category <> 'Others'
           UNION ALL SELECT url, job_category FROM silver_b WHERE job_category <> 'Others'""",
        "silver_b",
    ),
)
def filters_category(spark, sf_dir):
    from postlens.plans.gold import categorised

    boards = [fx.silver_a(spark, sf_dir), fx.silver_b(spark, sf_dir)]
    a, b = (categorised(board).select("url", "job_category") for board in boards)
    return a.unionByName(b)


@query(
    "filters_pending",
    with_ctes(
        """SELECT title, url, logo_url AS logo, working_location AS location, salary FROM staging_b WHERE NOT posted_to_discord
           UNION ALL SELECT title, url, logo_url, working_location, 'Sign-in for details.' FROM staging_a
           WHERE NOT posted_to_discord""",
        "staging_b",
    ),
)
def filters_pending(spark, sf_dir):
    from postlens.plans.alerts import pending_jobs

    b = pending_jobs(fx.staging_b(spark, sf_dir))
    return b.unionByName(pending_jobs(fx.staging_a(spark, sf_dir), fv.HIDDEN_SALARY))


REQUIRED = {
    "a": ("url", "descriptions", "requirements_and_experiences", "work_model"),
    "b": ("url", "descriptions", "requirements", "experiences", "salary", "level_of_education"),
}


def _required_sql(board: str) -> str:
    gaps = ", ".join(f"CASE WHEN coalesce({f}, '') = '' THEN '{f}' END" for f in REQUIRED[board])
    return f"""SELECT '{board}' AS board, url, len(missing) = 0 AS accepted, missing FROM (
        SELECT url, list_filter([{gaps}], lambda f: f IS NOT NULL) AS missing FROM staging_{board})"""


@query("required_fields", with_ctes(_required_sql("a") + " UNION ALL " + _required_sql("b"), "staging_b"))
def required_fields(spark, sf_dir):
    from postlens.operators.quality import required_gate

    boards = {"a": fx.staging_a(spark, sf_dir), "b": fx.staging_b(spark, sf_dir)}
    a, b = (
        required_gate(staging, REQUIRED[board]).select(
            F.lit(board).alias("board"), "url", (F.size("missing") == 0).alias("accepted"), "missing"
        )
        for board, staging in boards.items()
    )
    return a.unionByName(b)
