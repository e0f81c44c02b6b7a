"""Roll-ups, quantiles, constraint checks and derived relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from graniteflow.operators.latest import newest_per_key
from graniteflow.operators.stats import exact_quantiles
from graniteflow.sources.tables import table

SQL: dict[str, str] = {}
QUERIES = {}


def query(name, sql=None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


@query("industry_benchmark", """
SELECT industry, market, count(*) AS companies, round(percentile_cont(0.25) WITHIN GROUP (ORDER BY staff_num), 6) AS p25,
  round(percentile_cont(0.5) WITHIN GROUP (ORDER BY staff_num), 6) AS p50, round(percentile_cont(0.75) WITHIN GROUP (ORDER BY staff_num), 6) AS p75, CAST(sum(staff_num) AS BIGINT) AS staff
FROM (SELECT code, min(industry) AS industry, min(market) AS market, max(staff_num) AS staff_num FROM companies GROUP BY code) WHERE industry IS NOT NULL GROUP BY industry, market""")
def industry_benchmark(spark, sf):
    """Exact quartiles of the staff of each industry and market."""
    c = table(spark, sf, "companies", "code", "industry", "market", "staff_num").groupBy("code")
    c = c.agg(F.min("industry").alias("industry"), F.min("market").alias("market"), F.max("staff_num").alias("staff_num")).where("industry IS NOT NULL")
    q = exact_quantiles(c, ["industry", "market"], "staff_num", p25=0.25, p50=0.5, p75=0.75)
    sums = c.groupBy("industry", "market").agg(F.count("*").alias("companies"), F.sum("staff_num").alias("staff"))
    return sums.join(q, ["industry", "market"], "left").select("industry", "market", "companies", *(F.round(p, 6).alias(p) for p in ("p25", "p50", "p75")), "staff")


@query("latest_snapshot_benchmark", """
SELECT n_name, count(*) AS customers, round(percentile_cont(0.5) WITHIN GROUP (ORDER BY o_totalprice), 4) AS median_price, round(sum(o_totalprice), 2) AS total
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) o
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE rn = 1 GROUP BY n_name""")
def latest_snapshot(spark, sf):
    """The median of the last order of every customer, by nation."""
    o = newest_per_key(table(spark, sf, "orders", "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"), ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey"))
    c = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    n = table(spark, sf, "nation", "n_nationkey", "n_name")
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("n_nationkey") == F.col("c_nationkey"))
    medians = exact_quantiles(rows, ["n_name"], "o_totalprice", median_price=0.5)
    sums = rows.groupBy("n_name").agg(F.count("*").alias("customers"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return sums.join(medians, "n_name", "left").select("n_name", "customers", F.round("median_price", 4).alias("median_price"), "total")


@query("order_equation_check", """
SELECT o_orderkey, round(abs(o_totalprice - s) / nullif(abs(o_totalprice), 0), 6) AS imbalance
FROM orders JOIN (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS s FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
WHERE abs(o_totalprice - s) / nullif(abs(o_totalprice), 0) > 0.5""")
def order_equation(spark, sf):
    """Orders whose lines do not add up to their total; a total of zero has no imbalance."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice", "l_discount", "l_tax")
    s = li.groupBy("l_orderkey").agg(F.sum(F.expr("l_extendedprice * (1 - l_discount) * (1 + l_tax)")).alias("s"))
    o = table(spark, sf, "orders", "o_orderkey", "o_totalprice")
    off = F.try_divide(F.abs(F.col("o_totalprice") - F.col("s")), F.abs("o_totalprice"))
    return o.join(s, F.col("o_orderkey") == F.col("l_orderkey")).where(off > 0.5).select("o_orderkey", F.round(off, 6).alias("imbalance"))


@query("share_limit", """
SELECT l_orderkey, l_suppkey, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem GROUP BY l_orderkey, l_suppkey HAVING sum(l_quantity) > 50.5""")
def share_limit(spark, sf):
    """Groups whose shares exceed a limit in sum."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_suppkey", "l_quantity")
    return li.groupBy("l_orderkey", "l_suppkey").agg(F.sum("l_quantity").alias("quantity")).where("quantity > 50.5")


@query("price_anomalies", """
SELECT p_partkey, p_brand, round(p_retailprice / m, 6) AS ratio FROM part
JOIN (SELECT p_brand AS b, median(p_retailprice) AS m FROM part GROUP BY p_brand) ON b = p_brand WHERE p_retailprice > 1.05 * m""")
def price_anomalies(spark, sf):
    """Rows far above the median of their group: the aggregate is joined back, not windowed, so a hot group stays spread."""
    p = table(spark, sf, "part", "p_partkey", "p_brand", "p_retailprice")
    m = exact_quantiles(p, ["p_brand"], "p_retailprice", m=0.5).drop("n")
    return p.join(m, "p_brand").where("p_retailprice > 1.05 * m").select("p_partkey", "p_brand", F.round(F.expr("p_retailprice / m"), 6).alias("ratio"))


@query("peer_groups", """
SELECT code, industry, market, CAST(n - 1 AS BIGINT) AS peers FROM (SELECT DISTINCT code, industry, market FROM companies WHERE industry IS NOT NULL)
JOIN (SELECT industry, market, count(DISTINCT code) AS n FROM companies WHERE industry IS NOT NULL GROUP BY ALL) USING (industry, market)""")
def peer_groups(spark, sf):
    """Every company with its peer group and the number of peers, instead of all pairs."""
    c = table(spark, sf, "companies", "code", "industry", "market").where("industry IS NOT NULL").distinct()
    n = c.groupBy("industry", "market").agg((F.countDistinct("code") - 1).alias("peers"))
    return c.join(n, ["industry", "market"]).select("code", "industry", "market", "peers")


@query("former_names_in_use", """
SELECT name, count(DISTINCT code) AS companies, min(code) AS first_code FROM (
  SELECT code, unnest(string_split(pre_name, ',')) AS name FROM companies WHERE pre_name IS NOT NULL) WHERE trim(name) <> '' GROUP BY name""")
def former_names_in_use(spark, sf):
    """Former names with the number of companies that had them."""
    c = table(spark, sf, "companies", "code", "pre_name").select("code", F.explode(F.split("pre_name", ",")).alias("name")).where("trim(name) <> ''")
    return c.groupBy("name").agg(F.countDistinct("code").alias("companies"), F.min("code").alias("first_code"))


@query("mapping_propagation", """
SELECT DISTINCT c.c_nationkey AS nation, s.s_nationkey AS partner FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
WHERE NOT EXISTS (SELECT 1 FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey WHERE a.n_nationkey = c.c_nationkey AND b.n_nationkey = s.s_nationkey)""")
def mapping_propagation(spark, sf):
    """Pairs of nations that trade and are not already linked through their region."""
    o, c = table(spark, sf, "orders", "o_orderkey", "o_custkey"), table(spark, sf, "customer", "c_custkey", "c_nationkey")
    li, s = table(spark, sf, "lineitem", "l_orderkey", "l_suppkey"), table(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    n = table(spark, sf, "nation", "n_nationkey", "n_regionkey")
    pairs = o.join(c, F.col("c_custkey") == F.col("o_custkey")).join(li, F.col("l_orderkey") == F.col("o_orderkey")).join(s, F.col("s_suppkey") == F.col("l_suppkey"))
    pairs = pairs.select(F.col("c_nationkey").alias("nation"), F.col("s_nationkey").alias("partner")).distinct()
    linked = n.select(F.col("n_nationkey").alias("nation"), "n_regionkey").join(n.select(F.col("n_nationkey").alias("partner"), "n_regionkey"), "n_regionkey")
    return pairs.join(linked.select("nation", "partner"), ["nation", "partner"], "left_anti")


@query("indirect_links", """
SELECT DISTINCT o_custkey, p_brand FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE l_quantity > 45
EXCEPT SELECT o_custkey, p_brand FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE l_quantity <= 45""")
def indirect_links(spark, sf):
    """Links over two steps that exist by large orders only."""
    o, li = table(spark, sf, "orders", "o_orderkey", "o_custkey"), table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    p = table(spark, sf, "part", "p_partkey", "p_brand")
    rows = o.join(li, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("p_partkey") == F.col("l_partkey"))
    return rows.groupBy("o_custkey", "p_brand").agg(F.min("l_quantity").alias("least")).where("least > 45").select("o_custkey", "p_brand")


@query("pricing_summary", """
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc,
  round(avg(l_quantity), 6) AS avg_qty, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1999-09-02' GROUP BY ALL""")
def pricing_summary(spark, sf):
    """A roll-up with many aggregates in one pass."""
    li = table(spark, sf, "lineitem").where("l_shipdate <= TIMESTAMP '1999-09-02'")
    disc = F.expr("l_extendedprice * (1 - l_discount)")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"), F.round(F.sum(disc), 2).alias("sum_disc"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.count("*").alias("n"),
    )


@query("region_revenue", """
SELECT r_name, CAST(year(o_orderdate) AS INTEGER) AS order_year, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM region
JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""")
def region_revenue(spark, sf):
    """A star join rolled up by region and year."""
    r, n = table(spark, sf, "region"), table(spark, sf, "nation", "n_nationkey", "n_regionkey")
    c, o = table(spark, sf, "customer", "c_custkey", "c_nationkey"), table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice", "l_discount")
    rows = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("r_name", F.year("o_orderdate").alias("order_year")).agg(F.round(F.sum(F.expr("l_extendedprice * (1 - l_discount)")), 2).alias("revenue"))


def queries():
    return QUERIES


def oracle_sql():
    return SQL
