"""Scalar function queries (§2.8), one query per function family.

Values with no exact twin in the oracle engine (``initcap``, ``soundex``,
``sentences``, ``crc32``, ``hash``, ``xxhash64``, ``shuffle``) are
exercised in rows-only queries and in ``tests/test_functions.py``.
Arrays and maps are returned as sorted text so both engines agree on the
representation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.plans.registry import query


def r(c, n=6):
    return F.round(c, n)


def ts_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# ---------------------------------------------------------------- core
@query("fn_core", oracle="""
SELECT o_orderkey, 1 AS one, o_totalprice > 100000 AS expensive,
  coalesce(nullif(o_orderpriority, '1-URGENT'), 'urgent') AS prio,
  greatest(o_custkey, o_orderkey % 1000) AS hi, least(o_custkey, o_orderkey % 1000) AS lo,
  nullif(o_custkey % 2, 0) IS NULL AS even_cust,
  isnan(CASE WHEN o_orderkey % 2 = 0 THEN 'nan'::DOUBLE ELSE o_totalprice END) AS is_nan,
  round(CASE WHEN isnan(CASE WHEN o_orderkey % 2 = 0 THEN 'nan'::DOUBLE ELSE o_totalprice END) THEN 0.0
        ELSE o_totalprice END, 2) AS nanvl_price,
  o_orderstatus AS st, CAST(NULL AS VARCHAR) AS checked,
  CASE WHEN o_orderkey < 0 THEN 'never' ELSE 'ok' END AS guard
FROM orders
""")
def fn_core(t):
    o = t.orders
    nanny = F.when(o.o_orderkey % 2 == 0, F.lit(float("nan"))).otherwise(o.o_totalprice)
    s = F.struct(o.o_orderstatus.alias("st"), o.o_orderkey.alias("k"))
    return o.select(
        F.col("o_orderkey"), F.lit(1).alias("one"), F.expr("o_totalprice > 100000").alias("expensive"),
        F.coalesce(F.nullif(o.o_orderpriority, F.lit("1-URGENT")), F.lit("urgent")).alias("prio"),
        F.greatest(o.o_custkey, o.o_orderkey % 1000).alias("hi"), F.least(o.o_custkey, o.o_orderkey % 1000).alias("lo"),
        F.isnull(F.nullif(o.o_custkey % 2, F.lit(0))).alias("even_cust"), F.isnan(nanny).alias("is_nan"),
        F.round(F.nanvl(nanny, F.lit(0.0)), 2).alias("nanvl_price"), s.getField("st").alias("st"),
        F.assert_true(o.o_orderkey >= 0).cast("string").alias("checked"),
        F.when(o.o_orderkey < 0, F.raise_error("negative key")).otherwise(F.lit("ok")).alias("guard"))


# ---------------------------------------------------------------- math
@query("fn_math_basic", oracle="""
SELECT l_orderkey, l_linenumber, round(sqrt(l_quantity), 6) AS sqrt_q, round(cbrt(l_quantity), 6) AS cbrt_q,
  abs(l_quantity - 25) AS abs_d, CAST(ceil(l_extendedprice / 7) AS BIGINT) AS ceil_p,
  CAST(floor(l_extendedprice / 7) AS BIGINT) AS floor_p, round_even(l_quantity / 2, 0) AS rint_h,
  round(l_quantity / 2, 0) AS round_h, round_even(l_quantity / 2, 0) AS bround_h,
  CAST(sign(l_quantity - 25) AS DOUBLE) AS sgn, round(pow(l_discount * 10, 2), 6) AS pow_d,
  round(exp(l_discount), 6) AS exp_d, round(exp(l_discount) - 1, 6) AS expm1_d, round(ln(l_quantity), 6) AS ln_q,
  round(log(2, l_quantity), 6) AS log2b_q, round(log2(l_quantity), 6) AS log2_q, round(log10(l_quantity), 6) AS log10_q,
  round(ln(1 + l_discount), 6) AS log1p_d, CAST(factorial(l_linenumber) AS BIGINT) AS fact,
  round(sqrt(l_quantity * l_quantity + l_tax * l_tax), 6) AS hyp, ((l_orderkey - 5000) % 7 + 7) % 7 AS pm
FROM lineitem
""")
def fn_math_basic(t):
    li = t.lineitem
    q, d = li.l_quantity, li.l_discount
    return li.select(
        "l_orderkey", "l_linenumber", r(F.sqrt(q)).alias("sqrt_q"), r(F.cbrt(q)).alias("cbrt_q"),
        F.abs(q - 25).alias("abs_d"), F.ceil(li.l_extendedprice / 7).alias("ceil_p"),
        F.floor(li.l_extendedprice / 7).alias("floor_p"), F.rint(q / 2).alias("rint_h"),
        F.round(q / 2, 0).alias("round_h"), F.bround(q / 2, 0).alias("bround_h"),
        F.signum(q - 25).alias("sgn"), r(F.pow(d * 10, 2)).alias("pow_d"), r(F.exp(d)).alias("exp_d"),
        r(F.expm1(d)).alias("expm1_d"), r(F.log(q)).alias("ln_q"), r(F.log(2.0, q)).alias("log2b_q"),
        r(F.log2(q)).alias("log2_q"), r(F.log10(q)).alias("log10_q"), r(F.log1p(d)).alias("log1p_d"),
        F.factorial("l_linenumber").alias("fact"), r(F.hypot(q, li.l_tax)).alias("hyp"),
        F.pmod(li.l_orderkey - 5000, F.lit(7)).alias("pm"))


@query("fn_math_trig", oracle="""
SELECT l_orderkey, l_linenumber, round(sin(x), 6) AS sin_x, round(cos(x), 6) AS cos_x, round(tan(x), 6) AS tan_x,
  round(cot(x + 0.5), 6) AS cot_x, round(1 / cos(x), 6) AS sec_x, round(1 / sin(x + 0.5), 6) AS csc_x,
  round(asin(x), 6) AS asin_x, round(acos(x), 6) AS acos_x, round(atan(x), 6) AS atan_x,
  round(atan2(x, 0.5), 6) AS atan2_x, round(sinh(x), 6) AS sinh_x, round(cosh(x), 6) AS cosh_x, round(tanh(x), 6) AS tanh_x,
  round(asinh(x), 6) AS asinh_x, round(acosh(1 + x), 6) AS acosh_x, round(atanh(x), 6) AS atanh_x,
  round(degrees(x), 6) AS deg_x, round(radians(l_quantity), 6) AS rad_q
FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_discount AS x FROM lineitem)
""")
def fn_math_trig(t):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_discount").alias("x"))
    x = F.col("x")
    return li.select(
        "l_orderkey", "l_linenumber", r(F.sin(x)).alias("sin_x"), r(F.cos(x)).alias("cos_x"), r(F.tan(x)).alias("tan_x"),
        r(F.cot(x + 0.5)).alias("cot_x"), r(F.sec(x)).alias("sec_x"), r(F.csc(x + 0.5)).alias("csc_x"),
        r(F.asin(x)).alias("asin_x"), r(F.acos(x)).alias("acos_x"), r(F.atan(x)).alias("atan_x"),
        r(F.atan2(x, F.lit(0.5))).alias("atan2_x"), r(F.sinh(x)).alias("sinh_x"), r(F.cosh(x)).alias("cosh_x"),
        r(F.tanh(x)).alias("tanh_x"), r(F.asinh(x)).alias("asinh_x"), r(F.acosh(1 + x)).alias("acosh_x"),
        r(F.atanh(x)).alias("atanh_x"), r(F.degrees(x)).alias("deg_x"), r(F.radians("l_quantity")).alias("rad_q"))


@query("fn_bits", oracle="""
SELECT o_orderkey, ~o_orderkey AS not_k, o_orderkey << 2 AS shl, o_orderkey >> 1 AS shr, o_orderkey >> 3 AS shru,
  bin(o_orderkey) AS bin_k, hex(o_orderkey) AS hex_k, unhex(hex(o_orderkey)) AS unhex_k, bin(o_orderkey) AS conv_k
FROM orders
""")
def fn_bits(t):
    k = F.col("o_orderkey")
    return t.orders.select("o_orderkey", F.bitwise_not(k).alias("not_k"), F.shiftleft(k, 2).alias("shl"),
                           F.shiftright(k, 1).alias("shr"), F.shiftrightunsigned(k, 3).alias("shru"),
                           F.bin(k).alias("bin_k"), F.hex(k).alias("hex_k"), F.unhex(F.hex(k)).alias("unhex_k"),
                           F.conv(k.cast("string"), 10, 2).alias("conv_k"))


# ---------------------------------------------------------------- dates
@query("fn_date_parts", oracle="""
SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(quarter(ts) AS INTEGER) AS q, CAST(month(ts) AS INTEGER) AS m,
  CAST(dayofmonth(ts) AS INTEGER) AS dom, CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, CAST(dayofyear(ts) AS INTEGER) AS doy,
  CAST(weekofyear(ts) AS INTEGER) AS woy, CAST(hour(ts) AS INTEGER) AS h, CAST(minute(ts) AS INTEGER) AS mi,
  CAST(second(ts) AS INTEGER) AS s, last_day(CAST(ts AS DATE)) AS month_end,
  CAST(ts AS DATE) + CAST(((1 - isodow(ts)) + 6) % 7 + 1 AS INTEGER) AS next_monday
FROM events
""")
def fn_date_parts(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id", F.year(ts).alias("y"), F.quarter(ts).alias("q"), F.month(ts).alias("m"),
        F.dayofmonth(ts).alias("dom"), F.dayofweek(ts).alias("dow"), F.dayofyear(ts).alias("doy"),
        F.weekofyear(ts).alias("woy"), F.hour(ts).alias("h"), F.minute(ts).alias("mi"),
        F.second(ts).cast("int").alias("s"), F.last_day(ts.cast("date")).alias("month_end"),
        F.next_day(ts.cast("date"), "Mon").alias("next_monday"))


@query("fn_date_arith", oracle="""
SELECT o_orderkey, make_date(CAST(year(o_orderdate) AS INTEGER), 1, 15) AS mid_jan,
  CAST(o_orderdate AS DATE) + 10 AS plus10, CAST(o_orderdate AS DATE) - 10 AS minus10,
  CAST(date_diff('day', o_orderdate, TIMESTAMP '1998-12-31') AS INTEGER) AS days_left,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS plus3m,
  CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS month_start,
  CAST(date_trunc('year', CAST(o_orderdate AS DATE)) AS DATE) AS year_start,
  strftime(date_trunc('hour', o_orderdate + INTERVAL 90 MINUTE), '%Y-%m-%d %H:%M:%S') AS hour_start,
  round(CASE WHEN last_day(CAST(o_orderdate AS DATE)) = CAST(o_orderdate AS DATE)
        THEN CAST((1998 - year(o_orderdate)) * 12 + (12 - month(o_orderdate)) AS DOUBLE)
        ELSE (1998 - year(o_orderdate)) * 12 + (12 - month(o_orderdate)) + (31 - day(o_orderdate)) / 31.0 END, 8) AS months_to_end
FROM orders
""")
def fn_date_arith(t):
    o = t.orders
    d = o.o_orderdate.cast("date")
    return o.select(
        "o_orderkey", F.make_date(F.year(d), F.lit(1), F.lit(15)).alias("mid_jan"), F.date_add(d, 10).alias("plus10"),
        F.date_sub(d, 10).alias("minus10"), F.datediff(F.lit("1998-12-31").cast("date"), d).alias("days_left"),
        F.add_months(d, 3).alias("plus3m"), F.trunc(d, "MM").alias("month_start"), F.trunc(d, "year").alias("year_start"),
        ts_text(F.date_trunc("hour", o.o_orderdate + F.expr("INTERVAL 90 MINUTES"))).alias("hour_start"),
        F.months_between(F.lit("1998-12-31").cast("date"), d).alias("months_to_end"))


@query("fn_date_format", oracle="""
SELECT event_id, strftime(ts, '%Y/%m/%d %H:%M') AS fmt, CAST(strptime(strftime(ts, '%d.%m.%Y'), '%d.%m.%Y') AS DATE) AS parsed_date,
  strftime(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed_ts,
  strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS from_unix,
  CAST(floor(epoch(ts)) AS BIGINT) AS unix_ts,
  strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS ts_seconds,
  strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%Y-%m-%d %H:%M:%S') AS ny_time,
  strftime(timezone('UTC', timezone('Asia/Tokyo', ts)), '%Y-%m-%d %H:%M:%S') AS tokyo_to_utc
FROM events
""")
def fn_date_format(t):
    ts = F.col("ts")
    epoch = F.unix_timestamp(ts.cast("timestamp"))
    return t.events.select(
        "event_id", F.date_format(ts, "yyyy/MM/dd HH:mm").alias("fmt"),
        F.to_date(F.date_format(ts, "dd.MM.yyyy"), "dd.MM.yyyy").alias("parsed_date"),
        ts_text(F.to_timestamp(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), "yyyy-MM-dd HH:mm:ss")).alias("parsed_ts"),
        F.from_unixtime(epoch).alias("from_unix"), epoch.alias("unix_ts"),
        ts_text(F.timestamp_seconds(epoch)).alias("ts_seconds"),
        ts_text(F.from_utc_timestamp(ts.cast("timestamp"), "America/New_York")).alias("ny_time"),
        ts_text(F.to_utc_timestamp(ts.cast("timestamp"), "Asia/Tokyo")).alias("tokyo_to_utc"))


# ---------------------------------------------------------------- strings
@query("fn_string_case", oracle="""
SELECT c_custkey, upper(c_mktsegment) AS up, lower(c_name) AS low, trim('  ' || c_mktsegment || '  ') AS tr,
  ltrim('  ' || c_mktsegment) AS lt, rtrim(c_mktsegment || '  ') AS rt, lpad(c_mktsegment, 12, '*') AS lp,
  rpad(c_mktsegment, 4, '-') AS rp, repeat(c_mktsegment, 2) AS rep, CAST(length(c_name) AS INTEGER) AS len,
  CAST(strlen(c_name) AS INTEGER) AS octets, CAST(strlen(c_name) * 8 AS INTEGER) AS bits,
  translate(c_mktsegment, 'AEIOU', 'aeiou') AS tl,
  substring(c_name, 1, 2) || 'XX' || substring(c_name, 5) AS ov, CAST(ascii(c_mktsegment) AS INTEGER) AS asc_code
FROM customer
""")
def fn_string_case(t):
    c = t.customer
    seg = c.c_mktsegment
    return c.select(
        "c_custkey", F.upper(seg).alias("up"), F.lower("c_name").alias("low"),
        F.trim(F.concat(F.lit("  "), seg, F.lit("  "))).alias("tr"), F.ltrim(F.concat(F.lit("  "), seg)).alias("lt"),
        F.rtrim(F.concat(seg, F.lit("  "))).alias("rt"), F.lpad(seg, 12, "*").alias("lp"), F.rpad(seg, 4, "-").alias("rp"),
        F.repeat(seg, 2).alias("rep"), F.length("c_name").alias("len"), F.octet_length("c_name").alias("octets"),
        F.bit_length("c_name").alias("bits"), F.translate(seg, "AEIOU", "aeiou").alias("tl"),
        F.overlay("c_name", F.lit("XX"), 3, 2).alias("ov"), F.ascii(seg).alias("asc_code"))


@query("fn_string_search", oracle="""
SELECT p_partkey, CAST(instr(p_name, 'a') AS INTEGER) AS pos_a,
  CAST(CASE WHEN instr(substring(p_name, 3), 'e') = 0 THEN 0 ELSE instr(substring(p_name, 3), 'e') + 2 END AS INTEGER) AS loc_e,
  substring(p_name, 3, 4) AS sub, array_to_string(list_slice(string_split(p_name, ' '), 1, 2), ' ') AS first_two,
  CAST(levenshtein(p_brand, 'Brand#13') AS INTEGER) AS lev, concat_ws('|', p_brand, p_type, CAST(p_size AS VARCHAR)) AS cws,
  printf('%s-%05d', p_brand, p_size) AS fmt, format('{:,.2f}', p_retailprice) AS fnum,
  CAST(decode(encode(p_name)) AS VARCHAR) AS round_trip, to_base64(encode(p_brand)) AS b64,
  CAST(from_base64(to_base64(encode(p_brand))) AS VARCHAR) AS unb64
FROM part
""")
def fn_string_search(t):
    p = t.part
    return p.select(
        "p_partkey", F.instr("p_name", "a").alias("pos_a"), F.locate("e", "p_name", 3).alias("loc_e"),
        F.substring("p_name", 3, 4).alias("sub"), F.substring_index("p_name", " ", 2).alias("first_two"),
        F.levenshtein("p_brand", F.lit("Brand#13")).alias("lev"),
        F.concat_ws("|", "p_brand", "p_type", F.col("p_size").cast("string")).alias("cws"),
        F.format_string("%s-%05d", "p_brand", "p_size").alias("fmt"), F.format_number("p_retailprice", 2).alias("fnum"),
        F.decode(F.encode("p_name", "UTF-8"), "UTF-8").alias("round_trip"),
        F.base64(F.encode("p_brand", "UTF-8")).alias("b64"),
        F.decode(F.unbase64(F.base64(F.encode("p_brand", "UTF-8"))), "UTF-8").alias("unb64"))


@query("fn_regex", oracle=r"""
SELECT p_partkey, array_to_string(string_split_regex(p_type, '\s+'), '|') AS parts,
  regexp_extract(p_brand, 'Brand#(\d)(\d)', 2) AS digit2, regexp_replace(p_name, '[aeiou]', '_', 'g') AS novowel,
  CAST(len(string_split_regex(p_name, ' ')) AS INTEGER) AS n_words, regexp_matches(p_type, '^(STANDARD|SMALL)') AS std_small
FROM part
""")
def fn_regex(t):
    p = t.part
    return p.select("p_partkey", F.array_join(F.split("p_type", r"\s+"), "|").alias("parts"),
                    F.regexp_extract("p_brand", r"Brand#(\d)(\d)", 2).alias("digit2"),
                    F.regexp_replace("p_name", "[aeiou]", "_").alias("novowel"),
                    F.size(F.split("p_name", " ")).alias("n_words"),
                    F.col("p_type").rlike("^(STANDARD|SMALL)").alias("std_small"))


@query("fn_hash", oracle="""
SELECT c_custkey, md5(c_name) AS md5_name, sha1(c_name) AS sha1_name, sha256(c_name) AS sha256_name FROM customer
""")
def fn_hash(t):
    c = t.customer
    return c.select("c_custkey", F.md5("c_name").alias("md5_name"), F.sha1("c_name").alias("sha1_name"),
                    F.sha2("c_name", 256).alias("sha256_name"))


# ---------------------------------------------------------------- arrays
_ARR = "[CAST(l_linenumber AS BIGINT), CAST(l_quantity AS BIGINT), l_orderkey % 10]"


def _arr(t):
    li = t.lineitem
    return li.select("l_orderkey", "l_linenumber", F.array(F.col("l_linenumber").cast("bigint"),
                                                           F.col("l_quantity").cast("bigint"), F.col("l_orderkey") % 10).alias("a"))


def jt(c, sep=","):
    return F.array_join(c, sep)


@query("fn_array_build", oracle=f"""
SELECT l_orderkey, l_linenumber, array_to_string(a, ',') AS arr, array_to_string(list_transform(range(3), lambda x: l_linenumber), ',') AS rep,
  array_to_string(range(1, l_linenumber + 1), ',') AS seq,
  array_to_string(list_transform(list_zip(a, [10, 20, 30]), lambda p: CAST(p[1] AS VARCHAR) || ':' || CAST(p[2] AS VARCHAR)), ',') AS zipped,
  array_to_string(list_concat(a, [99]), ',') AS cat, array_to_string(flatten([a, [7, 8]]), ',') AS flat,
  array_to_string(list_append(a, -1), ',') AS app, array_to_string(list_concat([a[1]], [0], a[2:]), ',') AS ins,
  array_to_string(list_reverse(a), ',') AS rev, array_to_string(a[2:3], ',') AS sl
FROM (SELECT l_orderkey, l_linenumber, {_ARR} AS a FROM lineitem)
""")
def fn_array_build(t):
    d = _arr(t)
    a = F.col("a")
    zipped = F.transform(F.arrays_zip(a.alias("x"), F.array(F.lit(10), F.lit(20), F.lit(30)).alias("y")),
                         lambda s: F.concat(s["x"].cast("string"), F.lit(":"), s["y"].cast("string")))
    return d.select(
        "l_orderkey", "l_linenumber", jt(a).alias("arr"), jt(F.array_repeat("l_linenumber", 3)).alias("rep"),
        jt(F.sequence(F.lit(1), F.col("l_linenumber"))).alias("seq"), jt(zipped).alias("zipped"),
        jt(F.concat(a, F.array(F.lit(99).cast("bigint")))).alias("cat"),
        jt(F.flatten(F.array(a, F.array(F.lit(7).cast("bigint"), F.lit(8).cast("bigint"))))).alias("flat"),
        jt(F.array_append(a, F.lit(-1).cast("bigint"))).alias("app"), jt(F.array_insert(a, 2, F.lit(0).cast("bigint"))).alias("ins"),
        jt(F.reverse(a)).alias("rev"), jt(F.slice(a, 2, 2)).alias("sl"))


@query("fn_array_search", oracle=f"""
SELECT l_orderkey, l_linenumber, CAST(len(a) AS INTEGER) AS n, list_contains(a, 5) AS has5,
  CAST(coalesce(list_position(a, CAST(l_linenumber AS BIGINT)), 0) AS BIGINT) AS pos,
  a[2] AS second, a[1] AS first0, list_min(a) AS lo, list_max(a) AS hi, len(list_intersect(a, [1, 2])) > 0 AS overlap,
  array_to_string(list_reverse_sort(a), ',') AS sorted_desc, array_to_string(list_sort(a), ',') AS sorted_asc
FROM (SELECT l_orderkey, l_linenumber, {_ARR} AS a FROM lineitem)
""")
def fn_array_search(t):
    d = _arr(t)
    a = F.col("a")
    return d.select(
        "l_orderkey", "l_linenumber", F.size(a).alias("n"), F.array_contains(a, 5).alias("has5"),
        F.array_position(a, F.col("l_linenumber")).alias("pos"), F.try_element_at(a, F.lit(2)).alias("second"),
        F.get(a, 0).alias("first0"), F.array_min(a).alias("lo"), F.array_max(a).alias("hi"),
        F.arrays_overlap(a, F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))).alias("overlap"),
        jt(F.sort_array(a, asc=False)).alias("sorted_desc"), jt(F.array_sort(a)).alias("sorted_asc"))


@query("fn_array_set", oracle=f"""
SELECT l_orderkey, l_linenumber, array_to_string(list_sort(list_distinct(a)), ',') AS dist,
  array_to_string(list_sort(list_distinct(list_concat(a, [1, 2]))), ',') AS uni,
  array_to_string(list_sort(list_distinct(list_intersect(a, [1, 2, 3]))), ',') AS inter,
  array_to_string(list_sort(list_distinct(list_filter(a, lambda x: NOT list_contains([1, 2, 3], x)))), ',') AS exc,
  array_to_string(list_filter(a, lambda x: x <> 1), ',') AS removed,
  array_to_string(list_filter([a[1], NULL, a[2]], lambda x: x IS NOT NULL), ',') AS compacted
FROM (SELECT l_orderkey, l_linenumber, {_ARR} AS a FROM lineitem)
""")
def fn_array_set(t):
    d = _arr(t)
    a = F.col("a")
    one_two = F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))
    one_three = F.array(*[F.lit(i).cast("bigint") for i in (1, 2, 3)])
    return d.select(
        "l_orderkey", "l_linenumber", jt(F.array_sort(F.array_distinct(a))).alias("dist"),
        jt(F.array_sort(F.array_union(a, one_two))).alias("uni"),
        jt(F.array_sort(F.array_intersect(a, one_three))).alias("inter"),
        jt(F.array_sort(F.array_except(a, one_three))).alias("exc"), jt(F.array_remove(a, 1)).alias("removed"),
        jt(F.array_compact(F.array(a[0], F.lit(None).cast("bigint"), a[1]))).alias("compacted"))


@query("fn_hof", oracle=f"""
SELECT l_orderkey, l_linenumber, array_to_string(list_transform(a, lambda x: x * 2), ',') AS doubled,
  array_to_string(list_filter(a, lambda x: x % 2 = 0), ',') AS evens, list_bool_or(list_transform(a, lambda x: x > 40)) AS any_big,
  list_bool_and(list_transform(a, lambda x: x >= 0)) AS all_pos, list_reduce(a, lambda acc, x: acc + x, 0) AS total,
  array_to_string(list_transform(list_zip(a, [1, 2, 3]), lambda p: p[1] * p[2]), ',') AS zipped
FROM (SELECT l_orderkey, l_linenumber, {_ARR} AS a FROM lineitem)
""")
def fn_hof(t):
    d = _arr(t)
    a = F.col("a")
    three = F.array(*[F.lit(i).cast("bigint") for i in (1, 2, 3)])
    return d.select(
        "l_orderkey", "l_linenumber", jt(F.transform(a, lambda x: x * 2)).alias("doubled"),
        jt(F.filter(a, lambda x: x % 2 == 0)).alias("evens"), F.exists(a, lambda x: x > 40).alias("any_big"),
        F.forall(a, lambda x: x >= 0).alias("all_pos"),
        F.aggregate(a, F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("total"),
        jt(F.zip_with(a, three, lambda x, y: x * y)).alias("zipped"))


@query("fn_map", oracle="""
SELECT o_orderkey, array_to_string(list_sort(map_keys(m)), ',') AS keys, array_to_string(list_sort(map_values(m)), ',') AS vals,
  m['status'] AS status, CAST(len(map_keys(m)) + 1 AS INTEGER) AS n_concat, list_contains(map_keys(m), 'prio') AS has_prio,
  array_to_string(list_sort(list_filter(map_keys(m), lambda k: k <> 'status')), ',') AS filtered_keys,
  array_to_string(list_sort(list_transform(map_keys(m), lambda k: upper(k))), ',') AS upper_keys,
  upper(m['status']) AS upper_status
FROM (SELECT o_orderkey, MAP {'status': o_orderstatus, 'prio': o_orderpriority} AS m FROM orders)
""")
def fn_map(t):
    o = t.orders
    m = F.create_map(F.lit("status"), o.o_orderstatus, F.lit("prio"), o.o_orderpriority)
    d = o.select("o_orderkey", m.alias("m"))
    mm = F.col("m")
    extra = F.map_from_arrays(F.array(F.lit("x")), F.array(F.lit("1")))
    entries = F.map_from_entries(F.map_entries(mm))
    zipped = F.map_zip_with(mm, mm, lambda k, v1, v2: F.upper(v1))
    return d.select(
        "o_orderkey", jt(F.array_sort(F.map_keys(mm))).alias("keys"), jt(F.array_sort(F.map_values(entries))).alias("vals"),
        F.element_at(mm, F.lit("status")).alias("status"), F.size(F.map_concat(mm, extra)).alias("n_concat"),
        F.map_contains_key(mm, "prio").alias("has_prio"),
        jt(F.array_sort(F.map_keys(F.map_filter(mm, lambda k, v: k != "status")))).alias("filtered_keys"),
        jt(F.array_sort(F.map_keys(F.transform_keys(mm, lambda k, v: F.upper(k))))).alias("upper_keys"),
        F.element_at(F.transform_values(zipped, lambda k, v: v), F.lit("status")).alias("upper_status"))


@query("fn_json", oracle="""
SELECT event_id, json_extract_string(props, '$.k') AS k_text, json_extract_string(props, '$.k') AS k_tuple,
  TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int,
  to_json({'event_id': event_id, 'k': TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)}) AS as_json
FROM events
""")
def fn_json(t):
    ev = t.events
    parsed = F.from_json("props", "k INT")
    return ev.select("event_id", F.get_json_object("props", "$.k").alias("k_text"),
                     F.json_tuple("props", "k").alias("k_tuple"), parsed["k"].alias("k_int"),
                     F.to_json(F.struct("event_id", parsed["k"].alias("k"))).alias("as_json"))


@query("fn_csv", oracle="""
SELECT c_custkey, CAST(string_split(txt, ',')[1] AS BIGINT) AS id, string_split(txt, ',')[2] AS seg,
  CAST(string_split(txt, ',')[3] AS INTEGER) AS nation, txt AS back_to_csv
FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) || ',' || c_mktsegment || ',' || CAST(c_nationkey AS VARCHAR) AS txt FROM customer)
""")
def fn_csv(t):
    c = t.customer
    txt = F.concat_ws(",", c.c_custkey.cast("string"), c.c_mktsegment, c.c_nationkey.cast("string"))
    parsed = F.from_csv(txt, "id BIGINT, seg STRING, nation INT")
    d = c.select("c_custkey", parsed.alias("p"))
    return d.select("c_custkey", "p.id", "p.seg", "p.nation", F.to_csv("p").alias("back_to_csv"))


# ---------------------------------------------------------------- rows-only functions
@query("fn_meta")
def fn_meta(t):
    """Functions without a deterministic or shared twin: file name,
    ids, partition id, seeded random numbers, native hashes, shuffle,
    initcap, soundex, sentences."""
    p = t.part
    return p.select("p_partkey", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("mid"),
                    F.spark_partition_id().alias("pid"), F.rand(7).alias("u"), F.randn(7).alias("z"),
                    F.crc32(F.col("p_name").cast("binary")).alias("crc"), F.hash("p_name").alias("h"),
                    F.xxhash64("p_name").alias("xx"), F.shuffle(F.split("p_name", " ")).alias("shuffled"),
                    F.initcap("p_name").alias("title"), F.soundex("p_name").alias("sx"),
                    F.sentences(F.col("p_name")).alias("sent"), F.schema_of_json(F.lit('{"k": 1}')).alias("json_schema"),
                    F.schema_of_csv(F.lit("1,a")).alias("csv_schema"))


@query("fn_now")
def fn_now(t):
    return t.orders.select("o_orderkey", F.current_date().alias("today"), F.current_timestamp().alias("now"),
                           F.localtimestamp().alias("local_now"))


@query("age_days")
def age_days(t):
    """Age helper (current date minus a date) on order dates."""
    from marquee.functions.dates import age_days as age
    return t.orders.select("o_orderkey", age("o_orderdate").alias("age_days"))
