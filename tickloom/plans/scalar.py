"""Queries over scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import dates as dt
from tickloom.functions import numeric as nu
from tickloom.functions import text as tx
from tickloom.plans.registry import R, query, r, table


@query("math_minmax_power", f"""
SELECT event_id, greatest(value, 10.0, user_id / 3.0) AS hi, least(value, 10.0) AS lo, {R('ln(value)', 6)} AS ln, {R('log10(value)', 6)} AS lg, {R('exp(value / 100)', 6)} AS ex,
       {R('sqrt(value)', 6)} AS sq, CAST(sign(value - 10) AS BIGINT) AS sg, {R('pow(value, 1.5)')} AS pw, {R('pi()', 8)} AS pi FROM events""")
def _(spark, sf):
    df = table(spark, sf, "events")
    return df.select(
        "event_id", nu.maximum("value", F.lit(10.0), F.col("user_id") / 3.0).alias("hi"), nu.minimum("value", F.lit(10.0)).alias("lo"),
        r(nu.ln("value"), 6).alias("ln"), r(nu.log10("value"), 6).alias("lg"), r(nu.exp(F.col("value") / 100), 6).alias("ex"),
        r(nu.sqrt("value"), 6).alias("sq"), nu.sign(F.col("value") - 10).alias("sg"), r(nu.power("value", 1.5)).alias("pw"), r(nu.pi(), 8).alias("pi"))


@query("math_trigonometry", f"""
WITH x AS (SELECT event_id, value, value / (value + 1) AS u FROM events)
SELECT event_id, {R('sin(value)', 6)} AS s, {R('cos(value)', 6)} AS c, {R('tan(u)', 6)} AS t, {R('1 / tan(u)')} AS ct, {R('asin(u)', 6)} AS asn, {R('acos(u)', 6)} AS acs,
       {R('atan(value)', 6)} AS atn, {R('pi() / 2 - atan(value)', 6)} AS act FROM x""")
def _(spark, sf):
    x = table(spark, sf, "events").withColumn("u", F.col("value") / (F.col("value") + 1))
    return x.select(
        "event_id", r(nu.sin("value"), 6).alias("s"), r(nu.cos("value"), 6).alias("c"), r(nu.tan("u"), 6).alias("t"), r(nu.cot("u")).alias("ct"),
        r(nu.asin("u"), 6).alias("asn"), r(nu.acos("u"), 6).alias("acs"), r(nu.atan("value"), 6).alias("atn"), r(nu.acot("value"), 6).alias("act"))


@query("math_integers", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_orderkey % 7 AS m, (l_orderkey - 3000) // 7 AS d,
       gcd(l_orderkey, l_partkey)::BIGINT AS g, floor(l_extendedprice)::BIGINT AS f, ceil(l_extendedprice)::BIGINT AS c FROM lineitem""")
def _(spark, sf):
    df = table(spark, sf, "lineitem")
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return df.select(
        *ids, nu.mod("l_orderkey", 7).alias("m"), nu.div(F.col("l_orderkey") - 3000, 7).alias("d"), nu.gcd("l_orderkey", "l_partkey").alias("g"),
        nu.floor("l_extendedprice").alias("f"), nu.ceil("l_extendedprice").alias("c"))


@query("math_round_methods", """
WITH x AS (SELECT event_id, (value - 20) * 2 AS s FROM events)
SELECT event_id, floor(s + 0.5)::DOUBLE AS up, ceil(s - 0.5)::DOUBLE AS down, CASE WHEN s > 0 THEN ceil(s - 0.5) ELSE floor(s + 0.5) END::DOUBLE AS tz,
       CASE WHEN s > 0 THEN floor(s + 0.5) ELSE ceil(s - 0.5) END::DOUBLE AS az FROM x""")
def _(spark, sf):
    x = table(spark, sf, "events").withColumn("s", (F.col("value") - 20) * 2)
    names = {"up": "upward", "down": "downward", "tz": "towards_zero", "az": "away_from_zero"}
    return x.select("event_id", *[nu.round_("s", 0, m).alias(n) for n, m in names.items()])


@query("math_random")
def _(spark, sf):
    df = table(spark, sf, "events")
    return df.select("event_id", nu.rand(7).alias("u"), nu.rand_int(1, 7, 11).alias("die"))


@query("bit_operations", """
SELECT event_id, event_id & 12 AS a, event_id | 5 AS o, xor(event_id, user_id) AS x, ~event_id AS n, (event_id >> 2) & 1 AS b FROM events""")
def _(spark, sf):
    df = table(spark, sf, "events")
    return df.select("event_id", nu.bit_and("event_id", 12).alias("a"), nu.bit_or("event_id", 5).alias("o"), nu.bit_xor("event_id", F.col("user_id")).alias("x"),
                     nu.bit_not("event_id").alias("n"), nu.bit_at("event_id", 2).alias("b"))


@query("hash_codes", "SELECT doc_id, sha256(text) AS s256, sha1(text) AS s1 FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", nu.hash_code("text", "sha_256").alias("s256"), nu.hash_code("text", "sha_1").alias("s1"))


@query("conversions", f"""
SELECT event_id, trunc(value)::BIGINT AS i, printf('%.3f', value) AS t, CAST(CAST(value AS DECIMAL(38, 4)) AS VARCHAR) AS d,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, 0::BIGINT AS bad, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 0 END AS code,
       CASE WHEN abs(value - 20) / greatest(1, abs(value), 20) <= 0.1 THEN 0 WHEN value > 20 THEN 1 ELSE -1 END AS cmp, abs(value - 20) <= 1.5 AS eq FROM events""")
def _(spark, sf):
    df = table(spark, sf, "events")
    return df.select(
        "event_id", nu.to_int("value").alias("i"), nu.float_to_text("value", 3).alias("t"), nu.decimal_to_text("value", 4).alias("d"),
        nu.text_to_int(F.regexp_extract("props", r"(\d+)", 1)).alias("k"), nu.text_to_int("event_type").alias("bad"),
        nu.map_values("event_type", {"view": 1, "click": 2}, F.lit(0)).alias("code"), nu.compare("value", 20.0, 0.1).alias("cmp"), nu.equal("value", 20.0, 1.5).alias("eq"))


@query("division_by_zero", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'inf' ELSE CAST(value / 1 AS VARCHAR) END AS q FROM events""")
def _(spark, sf):
    df = table(spark, sf, "events")
    q = nu.divide("value", (F.col("event_id") % 2))
    return df.select("event_id", F.when(q == float("inf"), "inf").otherwise(q.cast("string")).alias("q"))


@query("text_basics", """
SELECT doc_id, length(text)::BIGINT AS n, upper(lang) AS u, lower(source) AS l, md5(trim('  ' || text || ' ')) AS t, md5(ltrim('  ' || text || ' ')) AS lt, md5(rtrim('  ' || text || ' ')) AS rt FROM documents""")
def _(spark, sf):
    df = table(spark, sf, "documents")
    padded = F.concat(F.lit("  "), "text", F.lit(" "))
    return df.select("doc_id", tx.length("text").alias("n"), tx.upper("lang").alias("u"), tx.lower("source").alias("l"), F.md5(tx.trim(padded)).alias("t"),
                     F.md5(tx.ltrim(padded)).alias("lt"), F.md5(tx.rtrim(padded)).alias("rt"))


@query("text_tokens", r"""
WITH p AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents)
SELECT doc_id, coalesce(w[1], '') AS first, coalesce(w[3], '') AS third, coalesce(w[-1], '') AS last, coalesce(w[len(w) + 100], '') AS beyond FROM p""")
def _(spark, sf):
    df = table(spark, sf, "documents")
    return df.select("doc_id", tx.token("text", " ", 0).alias("first"), tx.token("text", " ", 2).alias("third"), tx.token("text", " ", -1).alias("last"),
                     tx.token("text", " ", 1_000_000).alias("beyond"))


@query("text_substrings", """
SELECT doc_id, substr(text, 3, 5) AS s, right(text, 4) AS tail, substr(text, 2, 1) AS g, left(text, 3) AS f, substr(text, 3, greatest(length(text) - 5, 0)) AS sl FROM documents""")
def _(spark, sf):
    df = table(spark, sf, "documents")
    return df.select("doc_id", tx.substr("text", 2, 5).alias("s"), tx.substr("text", -4).alias("tail"), tx.get("text", 1).alias("g"), tx.first("text", 3).alias("f"),
                     tx.slice_("text", 2, -3).alias("sl"))


@query("text_search", r"""
SELECT doc_id, contains(text, 'the') AS c, starts_with(text, 'A') AS s, ends_with(text, '.') AS e, instr(text, 'an')::BIGINT - 1 AS f,
       CASE WHEN instr(substr(text, 11), 'an') = 0 THEN -1 ELSE instr(substr(text, 11), 'an') + 9 END::BIGINT AS f10, text LIKE '%ing%' AS lk, text ILIKE '%THE%' AS il,
       regexp_matches(text, '[0-9]{3}') AS m, regexp_matches(text, 'the', 'i') AS mi FROM documents""")
def _(spark, sf):
    df = table(spark, sf, "documents")
    return df.select(
        "doc_id", tx.contains("text", "the").alias("c"), tx.startswith("text", "A").alias("s"), tx.endswith("text", ".").alias("e"), tx.find("text", "an").alias("f"),
        tx.find("text", "an", 10).alias("f10"), tx.like("text", "%ing%").alias("lk"), tx.ilike("text", "%THE%").alias("il"),
        tx.match("text", "[0-9]{3}").alias("m"), tx.match("text", "the", case=False).alias("mi"))


@query("text_replace", r"""
SELECT doc_id, md5(replace(text, 'e', '3')) AS r, md5(regexp_replace(text, '[aeiou]+', '_', 'g')) AS ra, regexp_replace(source, '([a-z]+)([0-9]+)', '\2-\1') AS g,
       regexp_extract(source, '([a-z]+)([0-9]+)', 2) AS x, repeat(lang, 3) AS rp, lang || ':' || source AS c, substr(source, 1, 1) || 'XY' || substr(source, 4) AS i FROM documents""")
def _(spark, sf):
    df = table(spark, sf, "documents")
    return df.select(
        "doc_id", F.md5(tx.replace("text", "e", "3")).alias("r"), F.md5(tx.regex_replace("text", "[aeiou]+", "_", every=True)).alias("ra"),
        tx.regex_replace("source", "([a-z]+)([0-9]+)", r"\2-\1").alias("g"), tx.extract("source", "([a-z]+)([0-9]+)", r"\2").alias("x"), tx.repeat("lang", 3).alias("rp"),
        tx.concat("lang", F.lit(":"), "source").alias("c"), tx.insert("source", 2, 2, "XY").alias("i"))


@query("text_replace_first", r"SELECT doc_id, md5(regexp_replace(text, '[aeiou]+', '_')) AS f FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(tx.regex_replace("text", "[aeiou]+", "_")).alias("f"))


@query("text_extract_case", r"""
WITH x AS (SELECT c_custkey, regexp_extract(c_mktsegment, '([A-Z])([A-Z]*)', 1) a, regexp_extract(c_mktsegment, '([A-Z])([A-Z]*)', 2) b FROM customer)
SELECT c_custkey, 'seg ' || upper(a) || lower(b) AS s FROM x""")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", tx.extract("c_mktsegment", "([A-Z])([A-Z]*)", r"seg \u1\l2").alias("s"))


@query("conversation_turns", """
SELECT conv_id, turn, role, length(text)::BIGINT AS n, (sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING))::BIGINT AS total FROM conversations""")
def _(spark, sf):
    from tickloom.core import Series
    from tickloom.operators.project import cumsum

    df = table(spark, sf, "conversations").select("conv_id", "turn", "role", tx.length("text").alias("n")).withColumn("at", F.col("turn").cast("long"))
    s = Series(df, us_column="at", ts="at", seq=("turn",), keys=("conv_id",), slice_us=1000)
    return cumsum(s, {"total": F.col("n")}).df.select("conv_id", "turn", "role", "n", "total")


@query("page_hosts", r"""
SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, string_split(url, '/')[-1] AS tail, length(html)::BIGINT AS n FROM pages""")
def _(spark, sf):
    df = table(spark, sf, "pages")
    return df.select("page_id", tx.extract("url", "^https?://([^/]+)", r"\1").alias("host"), tx.token("url", "/", -1).alias("tail"), tx.length("html").alias("n"))


@query("format_line", r"""
SELECT event_id, 'user ' || CAST(user_id AS VARCHAR) || ' ' || printf('%.2f', value) || ' at ' || strftime(ts, '%Y/%m/%d %H:%M:%S') || ' ' || event_type AS line FROM events""")
def _(spark, sf):
    df = table(spark, sf, "events")
    return df.select("event_id", tx.format_("user {} {:.2f} at {:%Y/%m/%d %H:%M:%S} {kind}", F.col("user_id"), F.col("value"), F.col("ts"), kind=F.col("event_type")).alias("line"))


@query("date_parts", """
SELECT event_id, year(ts) AS y, quarter(ts) AS q, month(ts) AS m, strftime(ts, '%b') AS mn, day(ts) AS d, dayofyear(ts) AS doy, hour(ts) AS h, minute(ts) AS mi, second(ts) AS s,
       isodow(ts) AS dow, dayofweek(ts) AS dow0, strftime(ts, '%A') AS dn,
       floor((dayofyear(ts) + dayofweek(date_trunc('year', ts)) - 1) / 7)::BIGINT + 1 AS wk FROM events""")
def _(spark, sf):
    df = table(spark, sf, "events")
    return df.select(
        "event_id", dt.year("ts").alias("y"), dt.quarter("ts").alias("q"), dt.month("ts").alias("m"), dt.month_name("ts").alias("mn"), dt.day_of_month("ts").alias("d"),
        dt.day_of_year("ts").alias("doy"), dt.hour("ts").alias("h"), dt.minute("ts").alias("mi"), dt.second("ts").alias("s"), dt.day_of_week("ts").alias("dow"),
        dt.day_of_week("ts", 0, "sunday").alias("dow0"), dt.day_name("ts").alias("dn"), dt.week("ts").alias("wk"))


@query("date_parts_years", """
SELECT o_orderkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q, floor((dayofyear(o_orderdate) + dayofweek(date_trunc('year', o_orderdate)) - 1) / 7)::BIGINT + 1 AS wk,
       date_trunc('week', o_orderdate + INTERVAL 1 DAY)::TIMESTAMP - INTERVAL 1 DAY AS week FROM orders""")
def _(spark, sf):
    df = table(spark, sf, "orders")
    return df.select("o_orderkey", dt.year("o_orderdate").alias("y"), dt.quarter("o_orderdate").alias("q"), dt.week("o_orderdate").alias("wk"), dt.date_trunc("week", "o_orderdate").alias("week"))


@query("date_trunc_by_column", """
SELECT event_id, CASE event_type WHEN 'view' THEN date_trunc('day', ts)::TIMESTAMP WHEN 'click' THEN date_trunc('hour', ts) WHEN 'error' THEN date_trunc('minute', ts) WHEN 'signup' THEN date_trunc('month', ts)::TIMESTAMP ELSE ts END AS t FROM events""")
def _(spark, sf):
    df = table(spark, sf, "events")
    part = nu.map_values("event_type", {"view": "day", "click": "hour", "error": "minute", "signup": "month"}, F.lit("nanosecond"))
    return df.select("event_id", dt.date_trunc(part, "ts").alias("t"))


@query("date_zone_parts", """
WITH l AS (SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Tokyo' AS t FROM events)
SELECT event_id, hour(t) AS h, day(t) AS d, strftime(t, '%Y-%m-%d %H:%M') AS s FROM l""")
def _(spark, sf):
    df = table(spark, sf, "events")
    z = "Asia/Tokyo"
    return df.select("event_id", dt.hour("ts", z).alias("h"), dt.day_of_month("ts", z).alias("d"), dt.strftime("ts", "%Y-%m-%d %H:%M", z).alias("s"))


@query("date_parse", r"""
WITH x AS (SELECT event_id, ts, strftime(ts, '%m/%d/%Y %H:%M:%S') AS s FROM events)
SELECT event_id, strptime(s, '%m/%d/%Y %H:%M:%S') AS p, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ms FROM x""")
def _(spark, sf):
    df = table(spark, sf, "events").withColumn("s", dt.strftime("ts", "%m/%d/%Y %H:%M:%S"))
    from tickloom.core import micros

    millis = F.floor(micros("ts") / 1000).cast("string")
    return df.select("event_id", dt.to_datetime("s", "%m/%d/%Y %H:%M:%S").alias("p"), dt.to_datetime(millis, unit="ms").alias("ms"))


@query("date_arithmetic", """
SELECT event_id, ts + INTERVAL 2 MONTH AS m2, ts - INTERVAL 90 MINUTE AS m90, ts + INTERVAL 1 DAY * (event_id % 5) AS dn,
       (epoch_us(TIMESTAMP '2024-03-01') - epoch_us(ts)) // 3600000000 AS hours, (epoch_us(TIMESTAMP '2024-03-01') - epoch_us(ts)) // 86400000000 AS days FROM events""")
def _(spark, sf):
    df = table(spark, sf, "events")
    end = F.expr("TIMESTAMP_NTZ'2024-03-01'")
    return df.select("event_id", dt.add("ts", "Month", 2).alias("m2"), dt.add("ts", "Minute", -90).alias("m90"), dt.add("ts", "Day", F.col("event_id") % 5).alias("dn"),
                     dt.difference("Hour", end, "ts").alias("hours"), dt.difference("Day", end, "ts").alias("days"))
