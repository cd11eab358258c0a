"""Query catalog: name -> (Spark plan builder, DuckDB oracle SQL or None).

Each builder takes (spark, sf_dir) and returns a lazy DataFrame over the whole
record view. Oracle SQL reads the same parquet tables (pre-registered views)
and aliases every column to the Spark name. Money is rounded half-even to 2
decimals on both sides (``bround`` / ``round_even``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from agrolens.operators import aggregates as A
from agrolens.operators import detect as D
from agrolens.operators.joins import distinct_values, remap
from agrolens.records import DRIVER_PENDING_STATUS, RECORDS_SQL, city_lookup, records

QUERIES: dict = {}
ORACLE: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            body = sql.strip()
            if body[:4].upper() == "WITH":  # merge into the records CTE list
                ORACLE[name] = "WITH " + RECORDS_SQL + ",\n" + body[4:].lstrip()
            else:
                ORACLE[name] = "WITH " + RECORDS_SQL + "\n" + body
        return fn
    return deco


R2 = "round_even({}, 2)"


# ---------------------------------------------------------------- A1-A24, J2-J4, C14, C17
@register("county_subsidy_stats", """
SELECT county, round_even(coalesce(sum(unit_subsidy), 0), 2) AS total_subsidy,
       round_even(avg(unit_subsidy), 2) AS average_subsidy, count(unit_subsidy) AS equipment_count
FROM records WHERE county IS NOT NULL GROUP BY county""")
def county_subsidy_stats(spark, sf_dir):
    return A.county_stats(records(spark, sf_dir))


@register("kpi_card", f"""
SELECT round_even(coalesce(sum(quantity), 0), 2) AS total_machines,
       round_even(coalesce(sum(total_subsidy), 0), 2) AS total_subsidy,
       count(DISTINCT buyer) AS unique_buyers,
       count(*) FILTER (WHERE status = '{DRIVER_PENDING_STATUS}') AS pending_count
FROM records""")
def kpi_card(spark, sf_dir):
    return A.kpi_card(records(spark, sf_dir), pending=DRIVER_PENDING_STATUS)


@register("subsidy_summary", """
SELECT round_even(coalesce(sum(unit_subsidy), 0), 2) AS total_subsidy,
       round_even(avg(unit_subsidy), 2) AS average_subsidy, count(*) AS record_count
FROM records""")
def subsidy_summary(spark, sf_dir):
    return A.summary_stats(records(spark, sf_dir))


def _sum_by_sql(key):
    return f"""
SELECT {key}, round_even(coalesce(sum(quantity), 0), 2) AS quantity
FROM records WHERE {key} IS NOT NULL GROUP BY {key}"""


@register("category_quantity", _sum_by_sql("item_category"))
def category_quantity(spark, sf_dir):
    return A.sum_by(records(spark, sf_dir), "item_category")


@register("status_quantity", _sum_by_sql("status"))
def status_quantity(spark, sf_dir):
    return A.sum_by(records(spark, sf_dir), "status")


@register("buyer_quantity", _sum_by_sql("buyer"))
def buyer_quantity(spark, sf_dir):
    return A.sum_by(records(spark, sf_dir), "buyer")


@register("county_quantity_with_max", """
SELECT county, quantity, max(quantity) OVER () AS max_quantity FROM (
""" + _sum_by_sql("county") + ") t")
def county_quantity_with_max(spark, sf_dir):
    return A.with_max(A.sum_by(records(spark, sf_dir), "county"), "quantity", "max_quantity")


@register("daily_quantity", """
SELECT CAST(purchase_date AS DATE) AS day, round_even(coalesce(sum(quantity), 0), 2) AS quantity
FROM records WHERE purchase_date IS NOT NULL GROUP BY 1""")
def daily_quantity(spark, sf_dir):
    return A.daily_sum(records(spark, sf_dir))


@register("top10_category_share", """
SELECT item_category, quantity, round_even(quantity / sum(quantity) OVER () * 100, 2) AS pct FROM (
  SELECT item_category, round_even(coalesce(sum(quantity), 0), 2) AS quantity
  FROM records WHERE item_category IS NOT NULL GROUP BY item_category
  ORDER BY quantity DESC, item_category LIMIT 10) t""")
def top10_category_share(spark, sf_dir):
    return A.top_n_share(records(spark, sf_dir), "item_category", "quantity", 10)


@register("category_frequency_share", """
SELECT item_category, count(*) AS record_count,
       round_even(count(*) / (SELECT count(*) FROM records) * 100, 2) AS share_pct
FROM records WHERE item_category IS NOT NULL GROUP BY item_category""")
def category_frequency_share(spark, sf_dir):
    return A.frequency_share(records(spark, sf_dir), "item_category")


@register("monthly_subsidy", """
SELECT strftime(purchase_date, '%Y-%m') AS month,
       round_even(coalesce(sum(unit_subsidy), 0), 2) AS monthly_subsidy, count(unit_subsidy) AS monthly_count
FROM records WHERE purchase_date IS NOT NULL GROUP BY 1""")
def monthly_subsidy(spark, sf_dir):
    return A.monthly_stats(records(spark, sf_dir))


_TOP20_COUNT_SQL = """
SELECT manufacturer, count(*) AS record_count FROM records WHERE manufacturer IS NOT NULL
GROUP BY manufacturer ORDER BY record_count DESC, manufacturer LIMIT 20"""
_TOP20_SUB_SQL = """
SELECT manufacturer, round_even(coalesce(sum(unit_subsidy), 0), 2) AS subsidy_sum FROM records
WHERE manufacturer IS NOT NULL GROUP BY manufacturer ORDER BY subsidy_sum DESC, manufacturer LIMIT 20"""


@register("top20_manufacturer_count", _TOP20_COUNT_SQL)
def top20_manufacturer_count(spark, sf_dir):
    return A.top_by_count(records(spark, sf_dir), "manufacturer", 20)


@register("top20_manufacturer_subsidy", _TOP20_SUB_SQL)
def top20_manufacturer_subsidy(spark, sf_dir):
    return A.top_by_sum(records(spark, sf_dir), "manufacturer", "unit_subsidy", 20)


@register("manufacturer_top20_table", f"""
SELECT coalesce(a.manufacturer, b.manufacturer) AS manufacturer, a.record_count, b.subsidy_sum
FROM ({_TOP20_COUNT_SQL}) a FULL OUTER JOIN ({_TOP20_SUB_SQL}) b ON a.manufacturer = b.manufacturer""")
def manufacturer_top20_table(spark, sf_dir):
    return A.manufacturer_table(records(spark, sf_dir))


_REMAP_SQL = """
SELECT r.*, coalesce(lk.to_name, r.county) AS city
FROM records r LEFT JOIN city_lookup lk ON r.county = lk.from_name"""


@register("city_record_count", f"""
SELECT city, record_count, max(record_count) OVER () AS max_count FROM (
  SELECT city, count(quantity) AS record_count FROM ({_REMAP_SQL}) t WHERE city IS NOT NULL GROUP BY city) c""")
def city_record_count(spark, sf_dir):
    return A.remap_count(records(spark, sf_dir), city_lookup(spark, sf_dir), "county", "quantity")


@register("city_distinct_after_remap", f"SELECT DISTINCT city FROM ({_REMAP_SQL}) t")
def city_distinct_after_remap(spark, sf_dir):
    r = remap(records(spark, sf_dir), city_lookup(spark, sf_dir), "county", out="city")
    return distinct_values(r, "city")


_NO_COUNTY = "elsewhere"
_HEX_SQL = "('0x' || substr(md5(record_key), 1, 8))::UBIGINT"


def _register_city_sql() -> str:
    """Counts by city over the register's own table; every record gets one of its names, padded,
    or a name that is not in it."""
    from agrolens.operators.lookup import COUNTY_TO_CITY
    rows = ", ".join(f"('{k}', '{v}')" for k, v in COUNTY_TO_CITY.items())
    names = ", ".join(f"'{k}'" for k in [*COUNTY_TO_CITY, _NO_COUNTY])
    return f"""
WITH lk(from_name, to_name) AS (VALUES {rows}),
c AS (SELECT quantity, [{names}][({_HEX_SQL} % {len(COUNTY_TO_CITY) + 1})::BIGINT + 1] AS county FROM records)
SELECT city, record_count, max(record_count) OVER () AS max_count FROM (
  SELECT coalesce(to_name, county) AS city, count(quantity) AS record_count
  FROM c LEFT JOIN lk ON county = from_name GROUP BY 1) t"""


@register("register_city_counts", _register_city_sql())
def register_city_counts(spark, sf_dir):
    """C14 / A14 on the register's real county table."""
    from agrolens.operators.lookup import COUNTY_TO_CITY, county_city_lookup
    names = [*COUNTY_TO_CITY, _NO_COUNTY]
    at = F.conv(F.substring(F.md5("record_key"), 1, 8), 16, 10).cast("long") % len(names) + 1
    padded = F.concat(F.lit("\t"), F.element_at(F.array(*map(F.lit, names)), at.cast("int")), F.lit("\u3000 "))
    r = records(spark, sf_dir).select("quantity", padded.alias("county"))
    return A.remap_count(r, county_city_lookup(spark), "county", "quantity")


@register("market_position", """
SELECT item_category, manufacturer, round_even(sum(q), 2) AS total_count, round_even(avg(p), 2) AS avg_price,
       round_even(sum(p * q), 2) AS total_revenue
FROM (SELECT item_category, manufacturer, coalesce(unit_price, 0) AS p, coalesce(quantity, 0) AS q FROM records) t
WHERE p > 100 AND q >= 1 AND item_category IS NOT NULL AND manufacturer IS NOT NULL
GROUP BY item_category, manufacturer HAVING sum(q) >= 5""")
def market_position(spark, sf_dir):
    return A.market_position(records(spark, sf_dir))


@register("township_counts", """
SELECT township, count(*) AS record_count FROM records WHERE township IS NOT NULL GROUP BY township""")
def township_counts(spark, sf_dir):
    return A.top_by_count(records(spark, sf_dir), "township", None)


@register("item_counts", """
SELECT item_category, count(*) AS record_count FROM records WHERE item_category IS NOT NULL GROUP BY item_category""")
def item_counts(spark, sf_dir):
    return A.top_by_count(records(spark, sf_dir), "item_category", None)


@register("price_describe", """
SELECT count(unit_price) AS count, round_even(avg(unit_price), 4) AS mean,
       round_even(stddev_samp(unit_price), 4) AS std, round_even(min(unit_price), 4) AS min,
       round_even(quantile_cont(unit_price, 0.25), 4) AS p25, round_even(quantile_cont(unit_price, 0.5), 4) AS p50,
       round_even(quantile_cont(unit_price, 0.75), 4) AS p75, round_even(max(unit_price), 4) AS max
FROM records""")
def price_describe(spark, sf_dir):
    return A.describe(records(spark, sf_dir), "unit_price")


@register("price_histogram", """
WITH x AS (SELECT unit_price AS v FROM records WHERE unit_price IS NOT NULL AND NOT isnan(unit_price)),
rng AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 26 ELSE least(floor((v - lo) * 50 / (hi - lo)) + 1, 50) END AS INTEGER) AS bin
      FROM x, rng),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT CAST(g.i AS INTEGER) AS bin, round_even(lo + (g.i - 1) * (hi - lo) / 50, 4) AS bin_lo,
       round_even(lo + g.i * (hi - lo) / 50, 4) AS bin_hi, coalesce(c.n, 0) AS bin_count
FROM range(1, 51) g(i) CROSS JOIN rng LEFT JOIN c ON c.bin = g.i""")
def price_histogram(spark, sf_dir):
    return A.histogram(records(spark, sf_dir), "unit_price", 50)


@register("top_performers", """
SELECT item_category, rank, manufacturer, model, round_even(average_price, 2) AS average_price,
       round_even(sales_count, 2) AS sales_count, round_even(max_central_subsidy, 2) AS max_central_subsidy
FROM (SELECT *, row_number() OVER (PARTITION BY item_category ORDER BY average_price DESC, manufacturer, model) AS rank
      FROM (SELECT item_category, manufacturer, model, avg(unit_price) AS average_price,
                   sum(quantity) AS sales_count, max(unit_subsidy) AS max_central_subsidy
            FROM records WHERE item_category IS NOT NULL AND manufacturer IS NOT NULL AND model IS NOT NULL
            GROUP BY item_category, manufacturer, model) g) t
WHERE rank <= 5""")
def top_performers(spark, sf_dir):
    return A.top_performers(records(spark, sf_dir), n=5)


_TOP6_SQL = """
SELECT item_category, count(*) AS record_count FROM records WHERE item_category IS NOT NULL
GROUP BY item_category ORDER BY record_count DESC, item_category LIMIT 6"""


@register("top6_categories", _TOP6_SQL)
def top6_categories(spark, sf_dir):
    return A.top_categories(records(spark, sf_dir), n=6)


@register("subsidy_price_ols", f"""
SELECT item_category, round_even(regr_slope(unit_price, unit_subsidy), 6) AS slope,
       round_even(regr_intercept(unit_price, unit_subsidy), 4) AS intercept,
       round_even(regr_r2(unit_price, unit_subsidy), 6) AS r2, regr_count(unit_price, unit_subsidy)::BIGINT AS n
FROM records WHERE item_category IN (SELECT item_category FROM ({_TOP6_SQL}) t)
GROUP BY item_category""")
def subsidy_price_ols(spark, sf_dir):
    return A.ols_by_group(A.in_top_categories(records(spark, sf_dir), n=6))


@register("subsidy_price_sample", f"""
SELECT record_key, item_category, unit_subsidy, unit_price FROM records
WHERE item_category IN (SELECT item_category FROM ({_TOP6_SQL}) t)
ORDER BY md5('42' || record_key) LIMIT 5000""")
def subsidy_price_sample(spark, sf_dir):
    s = A.seeded_sample(A.in_top_categories(records(spark, sf_dir), n=6), 5000, 42)
    return s.select("record_key", "item_category", "unit_subsidy", "unit_price")


# ---------------------------------------------------------------- D1-D4, D7, W1-W5
_DUP_SQL = """
SELECT r.record_key, r.serial_no, r.buyer, r.item_category, r.purchase_date, d.dup_count
FROM records r JOIN (SELECT serial_no, count(*) AS dup_count FROM records WHERE serial_no IS NOT NULL
                     GROUP BY serial_no HAVING count(*) >= 2) d ON r.serial_no = d.serial_no"""


@register("duplicate_serials", _DUP_SQL)
def duplicate_serials(spark, sf_dir):
    return (D.duplicate_serials(records(spark, sf_dir))
            .select("record_key", "serial_no", "buyer", "item_category", "purchase_date", "dup_count"))


@register("duplicate_serial_count", f"SELECT count(*) AS flag_count FROM ({_DUP_SQL}) t")
def duplicate_serial_count(spark, sf_dir):
    d = D.duplicate_serials(records(spark, sf_dir)).withColumn("_f", F.lit(True))
    return A.flag_count(d, "_f")


def _rapid_sql(days):
    width = (days + 1) * 86_400_000_000
    return f"""
WITH d AS (SELECT * FROM records WHERE purchase_date IS NOT NULL AND buyer IS NOT NULL AND item_category IS NOT NULL),
g AS (SELECT buyer, item_category, epoch_us(purchase_date) AS t,
             lead(epoch_us(purchase_date)) OVER (PARTITION BY buyer, item_category ORDER BY purchase_date) AS t_next
      FROM d),
hit AS (SELECT DISTINCT buyer, item_category FROM g WHERE t_next - t < {width})
SELECT d.record_key, d.buyer, d.item_category, d.purchase_date, d.quantity
FROM d JOIN hit ON d.buyer = hit.buyer AND d.item_category = hit.item_category"""


def _rapid(days):
    def q(spark, sf_dir):
        return (D.rapid_repeat(records(spark, sf_dir), days=days)
                .select("record_key", "buyer", "item_category", "purchase_date", "quantity"))
    return q


register("rapid_repeat_30d", _rapid_sql(30))(_rapid(30))
register("rapid_repeat_1d", _rapid_sql(1))(_rapid(1))

_Z_SQL = """
SELECT r.record_key, r.unit_price, (r.unit_price - s.m) / nullif(s.sd, 0) AS z
FROM records r CROSS JOIN (SELECT avg(unit_price) AS m, stddev_samp(unit_price) AS sd FROM records) s"""


@register("price_zscore", f"""
SELECT record_key, round_even(z, 4) + 0.0 AS price_zscore, coalesce(abs(z) > 3, false) AS price_stat_anomaly
FROM ({_Z_SQL}) t""")
def price_zscore(spark, sf_dir):
    z = D.zscore_global(records(spark, sf_dir, columns=["record_key", "unit_price"]), "unit_price", 3.0)
    return z.select("record_key", F.bround("price_zscore", 4).alias("price_zscore"), "price_stat_anomaly")


@register("price_zscore_anomaly_count", f"""
SELECT count(*) FILTER (WHERE coalesce(abs(z) > 3, false)) AS flag_count FROM ({_Z_SQL}) t""")
def price_zscore_anomaly_count(spark, sf_dir):
    return A.flag_count(D.zscore_global(records(spark, sf_dir, columns=["unit_price"])), "price_stat_anomaly")


@register("price_zscore_alert", f"""
SELECT '{D.ALERT_TITLE}' AS title, '{D.ALERT_TEXT.split("{n}")[0]}' || CAST(n AS VARCHAR) || '{D.ALERT_TEXT.split("{n}")[1]}' AS text, n
FROM (SELECT count(*) FILTER (WHERE coalesce(abs(z) > 3, false)) AS n FROM ({_Z_SQL}) t) c WHERE n > 10""")
def price_zscore_alert(spark, sf_dir):
    return D.alert_if(D.zscore_global(records(spark, sf_dir, columns=["unit_price"])), "price_stat_anomaly", 10)


_MODEL_Z_SQL = """
WITH v AS (SELECT * FROM (SELECT *, coalesce(unit_price, 0) AS p, coalesce(quantity, 0) AS q FROM records) x
           WHERE p > 100 AND q >= 1),
s AS (SELECT model, avg(p) AS avg_model_price, stddev_samp(p) AS std_model_price FROM v
      WHERE model IS NOT NULL GROUP BY model),
z AS (SELECT v.*, s.avg_model_price, (v.p - s.avg_model_price) / nullif(s.std_model_price, 0) AS price_z_score
      FROM v LEFT JOIN s ON v.model = s.model)
SELECT * FROM z WHERE abs(price_z_score) > 3"""


@register("model_price_outliers_top10", f"""
{_MODEL_Z_SQL.replace("SELECT * FROM z WHERE", "SELECT record_key, item_category, manufacturer, model, round_even(p, 2) AS price, round_even(avg_model_price, 2) AS avg_model_price, round_even(unit_subsidy, 2) AS subsidy, purchase_date, round_even(price_z_score, 4) + 0.0 AS price_z_score FROM z WHERE")}
ORDER BY price_z_score DESC, record_key LIMIT 10""")
def model_price_outliers_top10(spark, sf_dir):
    from agrolens.functions.clean import valid_transactions
    o = D.zscore_by_group(valid_transactions(records(spark, sf_dir)), "model", "unit_price", 3.0)
    o = D.top_rows(o, "price_z_score", 10)
    return o.select("record_key", "item_category", "manufacturer", "model",
                    F.bround("unit_price", 2).alias("price"), F.bround("avg_model_price", 2).alias("avg_model_price"),
                    F.bround("unit_subsidy", 2).alias("subsidy"), "purchase_date",
                    F.bround("price_z_score", 4).alias("price_z_score"))


@register("model_price_outlier_count", f"SELECT count(*) AS flag_count FROM ({_MODEL_Z_SQL}) t")
def model_price_outlier_count(spark, sf_dir):
    from agrolens.functions.clean import valid_transactions
    o = D.zscore_by_group(valid_transactions(records(spark, sf_dir)), "model", "unit_price", 3.0)
    return A.flag_count(o.withColumn("_f", F.lit(True)), "_f")


# ---------------------------------------------------------------- S1-S9, C1-C13 round trips
def _text_records(spark, sf_dir, materialize=None):
    """The record view as the register delivers it: source headers (padded), every value
    text, padded buyer / serial, slash dates, numbers as Spark prints doubles, a filler column."""
    return _as_text(records(spark, sf_dir, materialize))


def _as_text(r, also=()):
    """Records (and the columns ``also``, unchanged) as register text."""
    from agrolens.schema import SOURCE_TO_COLUMN
    inv = {v: k for k, v in SOURCE_TO_COLUMN.items()}

    def pad(c):
        return F.concat(F.lit(" \t"), F.col(c).cast("string"), F.lit("　"))

    cols = [*also, F.col("record_key")]
    for c in ["county", "township", "item_category", "manufacturer", "product_name", "model",
              "dealer", "status"]:
        cols.append(F.col(c).alias(inv[c]))
    for c in ["buyer", "serial_no", "quantity", "unit_price", "unit_subsidy", "total_subsidy"]:
        cols.append(pad(c).alias(f" {inv[c]} "))
    cols.append(F.date_format("purchase_date", "yyyy/MM/dd HH:mm:ss").alias(inv["purchase_date"]))
    cols.append(F.lit(None).cast("string").alias("Unnamed: 17"))
    return r.select(*cols)


_CLEAN_COLS = ["record_key", "county", "township", "buyer", "item_category", "manufacturer",
               "product_name", "model", "quantity", "dealer", "unit_price", "unit_subsidy",
               "total_subsidy", "serial_no", "status"]


_CLEAN_SQL = f"""
SELECT {", ".join(_CLEAN_COLS)}, strftime(purchase_date, '%Y-%m-%d %H:%M:%S') AS purchase_date FROM records"""


@register("clean_roundtrip", _CLEAN_SQL)
def clean_roundtrip(spark, sf_dir):
    from agrolens.functions.clean import clean_records
    c = clean_records(_text_records(spark, sf_dir, materialize=False), keep=["record_key"])  # read once: nothing to keep
    return c.select(*_CLEAN_COLS, F.date_format("purchase_date", "yyyy-MM-dd HH:mm:ss").alias("purchase_date"))


@register("valid_revenue_rows", """
SELECT record_key, p AS unit_price, q AS quantity, round_even(p * q, 2) AS revenue
FROM (SELECT record_key, coalesce(unit_price, 0) AS p, coalesce(quantity, 0) AS q FROM records) t
WHERE p > 100 AND q >= 1""")
def valid_revenue_rows(spark, sf_dir):
    from agrolens.functions.clean import valid_transactions, with_revenue
    v = with_revenue(valid_transactions(records(spark, sf_dir)))
    return v.select("record_key", "unit_price", "quantity", F.bround("revenue", 2).alias("revenue"))


@register("feature_labels", """
SELECT record_key, CASE WHEN length(product_name || ' / ' || dealer) > 25
                        THEN substring(product_name || ' / ' || dealer, 1, 25) || '...'
                        ELSE product_name || ' / ' || dealer END AS label,
       translate(coalesce(CAST(township AS VARCHAR), 'NA') || '/' || item_category, '/ ', '__') AS file_key,
       coalesce(CAST(year(purchase_date) AS INTEGER), 2024) AS purchase_year
FROM records""")
def feature_labels(spark, sf_dir):
    from agrolens.functions.clean import category_text, safe_key, shorten_label, year_or_default
    r = records(spark, sf_dir)
    return r.select("record_key",
                    shorten_label(F.concat_ws(" / ", "product_name", "dealer")).alias("label"),
                    safe_key(F.concat_ws("/", category_text("township"), F.col("item_category"))).alias("file_key"),
                    year_or_default("purchase_date").alias("purchase_year"))


RECORDS_PER_PAGE = 50


def _html_text(c):
    """Cell text with the three characters HTML needs escaped; NULL -> empty cell."""
    t = F.coalesce(c.cast("string"), F.lit(""))
    for ch, ent in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        t = F.replace(t, F.lit(ch), F.lit(ent))
    return t


def _record_pages(spark, sf_dir, per_page: int = RECORDS_PER_PAGE):
    """The whole record view rendered as register pages: every page holds the first table
    (padded source headers, register-style text cells, an empty row) followed by a second
    table that must be ignored. Records go to page floor(u * P) with u uniform from a hash
    of the unique record key and P = ceil(n / per_page), so pages hold ~per_page rows
    whatever the key skew; the page count grows with the data. Records are shuffled by page
    typed, and rendered where their page is put together."""
    r = records(spark, sf_dir)
    n = r.agg(F.count(F.lit(1)).alias("_n"))
    pages_n = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(float(per_page))))
    u = F.shiftrightunsigned(F.xxhash64("record_key"), 11).cast("double") / F.lit(float(2 ** 53))
    dealt = r.crossJoin(F.broadcast(n)).select(F.floor(u * pages_n).alias("page_id"), *r.columns).repartition("page_id")
    raw = _as_text(dealt, also=["page_id"])
    cols = [c for c in raw.columns if c not in ("page_id", "record_key")]
    row = F.concat(F.lit("<tr><td>"), _html_text(F.col("record_key")), F.lit("</td>"),
                   *[F.concat(F.lit("<td>"), _html_text(F.col(f"`{c}`")), F.lit("</td>")) for c in cols],
                   F.lit("</tr><tr></tr>\n"))
    head = "".join(f"<th> {c.strip()} </th>" for c in ["record_key"] + cols)
    paged = raw.select("page_id", "record_key", row.alias("r"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("record_key", "r"))),
                                    lambda x: x["r"]), "")
    return (paged.groupBy("page_id")
                 .agg(F.concat(F.lit("<html><body><p>Register &amp; list</p><table class='t'><tr>" + head + "</tr>"),
                               rows, F.lit("</table><table><tr><th>x</th></tr><tr><td>ignored</td></tr>"
                                           "</table></body></html>")).alias("html")))


def _pages_to_records(rows):
    """Extracted (header, cells) rows -> named source columns -> cleaned records."""
    from agrolens.functions.clean import clean_records
    from agrolens.schema import SOURCE_TO_COLUMN
    names = ["record_key"] + [k for k in SOURCE_TO_COLUMN if k not in ("序号", "是否超录申请")]
    from agrolens.sources.html_tables import to_columns
    c = clean_records(to_columns(rows, names).drop("page_id", "row_no"), keep=["record_key"], number_rows=False)
    return c.select(*_CLEAN_COLS, F.date_format("purchase_date", "yyyy-MM-dd HH:mm:ss").alias("purchase_date"))


@register("html_table_roundtrip", _CLEAN_SQL)
def html_table_roundtrip(spark, sf_dir):
    """S4 end to end: every record rendered into register pages, the first table of each
    page extracted (mapInArrow), mapped by header text and cleaned back to typed records."""
    from agrolens.sources.html_tables import extract_tables
    return _pages_to_records(extract_tables(_record_pages(spark, sf_dir)))


@register("pages_without_table", """
SELECT page_id FROM pages WHERE html IS NULL OR NOT contains(lower(html), '<table')""")
def pages_without_table(spark, sf_dir):
    """S4's rejected pages: the raw web pages that hold no register table."""
    from agrolens.records import table
    from agrolens.sources.html_tables import rejected_pages
    return rejected_pages(table(spark, sf_dir, "pages"))


@register("page_batches", """
WITH p AS (SELECT page_id + 1 AS page_no FROM pages),
l AS (SELECT max(page_no) AS last_page FROM p),
b AS (SELECT CAST(floor((page_no - 1) / 100) * 100 + 1 AS BIGINT) AS batch_start, last_page FROM p, l)
SELECT batch_start, least(batch_start + 99, last_page) AS batch_end,
       CAST(batch_start AS VARCHAR) || '_to_' || CAST(least(batch_start + 99, last_page) AS VARCHAR) AS batch,
       count(*) AS page_count
FROM b GROUP BY batch_start, last_page""")
def page_batches(spark, sf_dir):
    from agrolens.records import table
    from agrolens.sources.sinks import page_batches as pb
    p = table(spark, sf_dir, "pages").select((F.col("page_id") + 1).alias("page_no"))
    return (pb(p, "page_no", 100, 1).groupBy("batch_start", "batch_end", "batch")
            .agg(F.count(F.lit(1)).alias("page_count")))


@register("written_batches_merged", """
WITH p AS (SELECT page_id + 1 AS page_no, coalesce(length(html), 0) AS n FROM pages),
l AS (SELECT max(page_no) AS last_page FROM p),
b AS (SELECT CAST(floor((page_no - 1) / 100) * 100 + 1 AS BIGINT) AS batch_start, n, page_no, last_page FROM p, l)
SELECT CAST(batch_start AS VARCHAR) || '_to_' || CAST(least(batch_start + 99, last_page) AS VARCHAR) AS batch,
       count(*) AS page_count, sum(page_no)::BIGINT AS page_sum, sum(n)::BIGINT AS html_chars
FROM b GROUP BY batch_start, last_page""")
def written_batches_merged(spark, sf_dir):
    """S5 + S6: pages written as one folder per batch, then merged back from the folders."""
    import uuid

    from agrolens.records import table
    from agrolens.session import scratch_path
    from agrolens.sources.readers import merge_batches
    from agrolens.sources.sinks import write_page_batches
    path = scratch_path(spark, "batches-" + uuid.uuid4().hex[:12])
    p = table(spark, sf_dir, "pages").select((F.col("page_id") + 1).alias("page_no"), "html")
    write_page_batches(p, path, page_col="page_no")
    return (merge_batches(spark, [path]).groupBy("batch")
            .agg(F.count(F.lit(1)).alias("page_count"), F.sum("page_no").alias("page_sum"),
                 F.sum(F.coalesce(F.length("html"), F.lit(0))).alias("html_chars")))


@register("recollected_batches_merged", """
WITH p AS (SELECT page_id + 1 AS page_no, coalesce(length(html), 0) AS n FROM pages),
b AS (SELECT CAST(floor((page_no - 1) / 100) * 100 + 1 AS BIGINT) AS batch_start, page_no, n FROM p),
c AS (SELECT batch_start, page_no, CASE WHEN batch_start = 1 THEN 5 ELSE n END AS n FROM b
      WHERE batch_start <> 1 OR page_no % 2 = 0)
SELECT CAST(batch_start AS VARCHAR) || '_to_' || CAST(batch_start + 99 AS VARCHAR) AS batch,
       count(*) AS page_count, sum(page_no)::BIGINT AS page_sum, sum(n)::BIGINT AS html_chars
FROM c GROUP BY batch_start""")
def recollected_batches_merged(spark, sf_dir):
    """S5 + S6: all batches written, the first one collected again with other pages, and all merged: only its folder changed."""
    import uuid

    from agrolens.records import table
    from agrolens.session import scratch_path
    from agrolens.sources.readers import merge_batches
    from agrolens.sources.sinks import write_page_batches
    path = scratch_path(spark, "batches-" + uuid.uuid4().hex[:12])
    p = table(spark, sf_dir, "pages").select((F.col("page_id") + 1).alias("page_no"), "html")
    write_page_batches(p, path, page_col="page_no", clip=False)
    again = p.where((F.col("page_no") <= 100) & (F.col("page_no") % 2 == 0)).withColumn("html", F.lit("again"))
    write_page_batches(again, path, page_col="page_no", clip=False)
    return (merge_batches(spark, [path]).groupBy("batch")
            .agg(F.count(F.lit(1)).alias("page_count"), F.sum("page_no").alias("page_sum"),
                 F.sum(F.coalesce(F.length("html"), F.lit(0))).alias("html_chars")))


@register("csv_charsets_merged", """
SELECT record_key, '县 ' || county AS county, status FROM records""")
def csv_charsets_merged(spark, sf_dir):
    """Records written as CSV, one part in UTF-8 and one in GBK, read back as one table."""
    import uuid

    from agrolens.session import scratch_path
    from agrolens.sources.readers import read_csv_any
    path = scratch_path(spark, "csv-" + uuid.uuid4().hex[:12])
    r = records(spark, sf_dir).select("record_key", F.concat(F.lit("县 "), "county").alias("county"), "status")
    old = spark.conf.get("spark.sql.legacy.javaCharsets")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        for part, charset in (("F", "UTF-8"), ("rest", "GBK")):
            mine = F.coalesce(F.col("status"), F.lit("")) == "F"
            r.where(mine if part == "F" else ~mine).write.option("header", True).option("encoding", charset).csv(f"{path}/{part}")
    finally:
        spark.conf.set("spark.sql.legacy.javaCharsets", old)
    return read_csv_any(spark, [f"{path}/F", f"{path}/rest"]).select("record_key", "county", "status")


@register("report_written_back", """
SELECT 'category' AS name, item_category AS key, round_even(sum(quantity), 2) AS quantity FROM records
WHERE item_category IS NOT NULL GROUP BY item_category
UNION ALL
SELECT 'status', status, round_even(sum(quantity), 2) FROM records WHERE status IS NOT NULL GROUP BY status""")
def report_written_back(spark, sf_dir):
    """S7 + S8: result tables written as CSV side by side and read back as text."""
    import uuid

    from agrolens.session import scratch_path
    from agrolens.sources.readers import read_records
    from agrolens.sources.sinks import write_report
    r = records(spark, sf_dir)
    tables = {name: r.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("key")).agg(F.sum("quantity").alias("quantity"))
              for name, c in (("category", "item_category"), ("status", "status"))}
    paths = write_report(tables, scratch_path(spark, "report-" + uuid.uuid4().hex[:12]), "csv")
    back = [read_records(spark, p, "csv").withColumn("name", F.lit(n)) for n, p in paths.items()]
    return back[0].unionByName(back[1]).select("name", "key", F.bround(F.col("quantity").cast("double"), 2).alias("quantity"))


@register("merged_batches", """
SELECT record_key, status, CASE WHEN status = 'F' THEN NULL ELSE dealer END AS dealer FROM records""")
def merged_batches(spark, sf_dir):
    from agrolens.operators.joins import union_batches
    r = records(spark, sf_dir).select("record_key", "status", "dealer")
    a = r.where(F.col("status") == "F").select("record_key", "status")          # batch without dealer
    b = r.where((F.col("status") != "F") | F.col("status").isNull())
    return union_batches([a, b]).select("record_key", "status", "dealer")


@register("summary_document", """
WITH s AS (SELECT count(unit_price)::DOUBLE AS n, round_even(avg(unit_price), 4) AS mean,
       round_even(stddev_samp(unit_price), 4) AS std, round_even(min(unit_price), 4) AS lo,
       round_even(quantile_cont(unit_price, 0.25), 4) AS p25, round_even(quantile_cont(unit_price, 0.5), 4) AS p50,
       round_even(quantile_cont(unit_price, 0.75), 4) AS p75, round_even(max(unit_price), 4) AS hi FROM records)
SELECT 'rows' AS section, 'total' AS key, count(*)::DOUBLE AS value FROM records
UNION ALL SELECT 'region', township, n::DOUBLE FROM (
  SELECT township, count(*) AS n FROM records WHERE township IS NOT NULL GROUP BY township ORDER BY n DESC, township LIMIT 20) t
UNION ALL SELECT 'item', item_category, count(*)::DOUBLE FROM records WHERE item_category IS NOT NULL GROUP BY item_category
UNION ALL SELECT 'price', unnest(['count', 'mean', 'std', 'min', 'p25', 'p50', 'p75', 'max']),
  unnest([n, mean, std, lo, p25, p50, p75, hi]) FROM s""")
def summary_document(spark, sf_dir):
    from agrolens.sources.sinks import summary_document as sd
    return sd(records(spark, sf_dir, columns=["township", "item_category", "unit_price"]))


# ---------------------------------------------------------------- M2, M6-M8, D6, M13 baseline
_BUCKET_SQL = "(('0x' || substr(md5(record_key), 1, 8))::UBIGINT % 100)"


@register("train_test_split", f"""
SELECT CASE WHEN {_BUCKET_SQL} >= 80 THEN 'test' ELSE 'train' END AS part, count(*) AS record_count
FROM records GROUP BY 1""")
def train_test_split(spark, sf_dir):
    from agrolens.operators.features import split_train_test
    s = split_train_test(records(spark, sf_dir))
    return (s.groupBy(F.when(F.col("is_test"), "test").otherwise("train").alias("part"))
             .agg(F.count(F.lit(1)).alias("record_count")))


@register("ordered_target_stat", """
SELECT record_key, manufacturer,
       round_even((coalesce(sum(unit_price) OVER w, 0) + (SELECT avg(unit_price) FROM records))
                  / (coalesce(count(unit_price) OVER w, 0) + 1), 4) AS manufacturer_enc
FROM records
WINDOW w AS (PARTITION BY manufacturer ORDER BY md5(record_key) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def ordered_target_stat(spark, sf_dir):
    from agrolens.operators.features import ordered_target_encoding
    e = ordered_target_encoding(records(spark, sf_dir), "manufacturer", "unit_price")
    return e.select("record_key", "manufacturer", F.bround("manufacturer_enc", 4).alias("manufacturer_enc"))


_GM_SQL = f"""
WITH s AS (SELECT model, avg(unit_price) AS pred FROM records WHERE {_BUCKET_SQL} < 80 AND model IS NOT NULL
           GROUP BY model),
sc AS (SELECT r.*, r.unit_price AS actual_price, s.pred AS predicted_price, {_BUCKET_SQL} >= 80 AS is_test
       FROM records r JOIN s ON r.model = s.model),
m AS (SELECT avg(abs(actual_price - predicted_price)) AS mae,
             stddev_pop(abs(actual_price - predicted_price)) AS mae_std,
             avg((actual_price - predicted_price) ^ 2) AS mse, var_pop(actual_price) AS vy, count(*) AS n
      FROM sc WHERE is_test)"""


def _group_mean_scored(spark, sf_dir):
    from agrolens.operators.features import split_train_test
    r = split_train_test(records(spark, sf_dir))
    pred = (r.where(~F.col("is_test") & F.col("model").isNotNull()).groupBy("model")
             .agg(F.avg("unit_price").alias("predicted_price")))
    return r.join(pred, "model", "inner").withColumn("actual_price", F.col("unit_price"))


@register("group_mean_metrics", _GM_SQL + """
SELECT n, round_even(mse, 4) AS mse, round_even(sqrt(mse), 4) AS rmse, round_even(1 - mse / vy, 6) AS r2,
       round_even(mae, 4) AS mae, round_even(mae_std, 4) AS mae_std FROM m""")
def group_mean_metrics(spark, sf_dir):
    from agrolens.operators.features import regression_metrics
    m = regression_metrics(_group_mean_scored(spark, sf_dir).where(F.col("is_test")))
    return m.select("n", F.bround("mse", 4).alias("mse"), F.bround("rmse", 4).alias("rmse"),
                    F.bround("r2", 6).alias("r2"), F.bround("mae", 4).alias("mae"),
                    F.bround("mae_std", 4).alias("mae_std"))


_RESID_SQL = _GM_SQL + """,
a AS (SELECT sc.*, abs(actual_price - predicted_price) AS prediction_error,
             actual_price - predicted_price AS price_difference
      FROM sc CROSS JOIN m WHERE abs(actual_price - predicted_price) > m.mae + 2 * m.mae_std)"""


@register("residual_anomalies_top10", _RESID_SQL + """
SELECT record_key, county, item_category, manufacturer, dealer, round_even(actual_price, 2) AS actual_price,
       round_even(predicted_price, 2) AS predicted_price, round_even(price_difference, 2) AS price_difference
FROM a ORDER BY prediction_error DESC, record_key LIMIT 10""")
def residual_anomalies_top10(spark, sf_dir):
    from agrolens.operators.features import regression_metrics
    sc = _group_mean_scored(spark, sf_dir)
    m = regression_metrics(sc.where(F.col("is_test")))
    a = D.top_rows(D.residual_anomaly(sc, m), "prediction_error", 10)
    return a.select("record_key", "county", "item_category", "manufacturer", "dealer",
                    F.bround("actual_price", 2).alias("actual_price"),
                    F.bround("predicted_price", 2).alias("predicted_price"),
                    F.bround("price_difference", 2).alias("price_difference"))


@register("residual_anomaly_count", _RESID_SQL + "\nSELECT count(*) AS flag_count FROM a")
def residual_anomaly_count(spark, sf_dir):
    from agrolens.operators.features import regression_metrics
    sc = _group_mean_scored(spark, sf_dir)
    m = regression_metrics(sc.where(F.col("is_test")))
    return A.flag_count(D.residual_anomaly(sc, m).withColumn("_f", F.lit(True)), "_f")


@register("linear_forecast", """
WITH d AS (SELECT township, CAST(purchase_date AS DATE) AS ds, CAST(quantity AS DOUBLE) AS y,
                  CAST(date_diff('day', DATE '1970-01-01', CAST(purchase_date AS DATE)) AS DOUBLE) AS x
           FROM records WHERE township IS NOT NULL AND purchase_date IS NOT NULL AND quantity IS NOT NULL),
f AS (SELECT township, count(*) AS n, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept,
             regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, avg(y) AS ybar, max(ds) AS last_ds
      FROM d GROUP BY township HAVING count(*) >= 10),
f2 AS (SELECT *, sqrt(greatest(syy - sxy * sxy / nullif(sxx, 0), 0) / nullif(n - 2, 0)) AS sigma FROM f),
days AS (SELECT DISTINCT d.township, d.ds FROM d JOIN f ON d.township = f.township
         UNION ALL
         SELECT township, CAST(last_ds + INTERVAL (i) DAY AS DATE) FROM f, range(1, 31) r(i)),
p AS (SELECT days.township, days.ds,
             coalesce(intercept + slope * date_diff('day', DATE '1970-01-01', days.ds), ybar) AS yhat,
             1.2815515655446004 * coalesce(sigma, 0) AS band
      FROM days JOIN f2 ON days.township = f2.township)
SELECT township, ds, round_even(yhat, 4) AS yhat, round_even(yhat - band, 4) AS yhat_lower,
       round_even(yhat + band, 4) AS yhat_upper FROM p""")
def linear_forecast(spark, sf_dir):
    from agrolens.operators.forecast import linear_forecast as lf
    return lf(records(spark, sf_dir), "township", "purchase_date", "quantity", 30, 10)


@register("seasonal_forecast")
def seasonal_forecast(spark, sf_dir):
    from agrolens.operators.forecast import seasonal_forecast as sf
    return sf(records(spark, sf_dir), "township", "purchase_date", "quantity", 30, 10)


@register("changepoint_forecast")
def changepoint_forecast(spark, sf_dir):
    """Trend with changepoints, weekly and yearly terms, bands that widen."""
    from agrolens.operators.trend import changepoint_forecast as cf
    return cf(records(spark, sf_dir), "township", "purchase_date", "quantity", 30, 10)


@register("changepoint_forecast_checks", """
WITH d AS (SELECT township, CAST(purchase_date AS DATE) AS ds FROM records
           WHERE township IS NOT NULL AND purchase_date IS NOT NULL AND quantity IS NOT NULL)
SELECT township, count(DISTINCT ds) AS n_history, max(ds) AS last_day, 30::BIGINT AS n_future, true AS band_never_narrows,
       true AS share_inside_is_near_80
FROM d GROUP BY township HAVING count(*) >= 10""")
def changepoint_forecast_checks(spark, sf_dir):
    """M13 in values that do not depend on the fit: days forecast, widths by horizon, and the share of all records inside."""
    from pyspark.sql.window import Window
    r = records(spark, sf_dir)
    f = changepoint_forecast(spark, sf_dir).withColumn("width", F.col("yhat_upper") - F.col("yhat_lower"))
    before = F.lag("width").over(Window.partitionBy("township").orderBy("ds"))  # days of a group
    told = f.withColumn("narrower", F.col("future") & (F.col("width") < before - 1e-9)).groupBy("township").agg(
        F.count(F.when(~F.col("future"), 1)).alias("n_history"), F.max(F.when(~F.col("future"), F.col("ds"))).alias("last_day"),
        F.count(F.when(F.col("future"), 1)).alias("n_future"), (~F.bool_or("narrower")).alias("band_never_narrows"))
    days = f.select(F.col("township").alias("t"), F.col("ds").alias("d"), "yhat_lower", "yhat_upper")
    inside = (r.where(F.col("quantity").isNotNull()).join(days, (F.col("township") == F.col("t")) & (F.to_date("purchase_date") == F.col("d")))
              .groupBy("t").agg(F.avg(F.col("quantity").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("int")).alias("share")))
    return told.join(inside, F.col("township") == F.col("t")).select(
        "township", "n_history", "last_day", "n_future", "band_never_narrows", F.col("share").between(0.65, 0.95).alias("share_inside_is_near_80"))


@register("forecast_skipped_groups", """
SELECT buyer, count(*) AS n_rows, count(*) FILTER (purchase_date IS NOT NULL AND quantity IS NOT NULL) AS usable_rows,
       CASE WHEN count(*) FILTER (purchase_date IS NOT NULL AND quantity IS NOT NULL) = 0 THEN 'no usable row' ELSE 'too few rows' END AS reason
FROM records WHERE buyer IS NOT NULL GROUP BY buyer
HAVING count(*) FILTER (purchase_date IS NOT NULL AND quantity IS NOT NULL) < 30""")
def forecast_skipped_groups(spark, sf_dir):
    """Buyers that get no forecast of their own, and why."""
    from agrolens.operators.trend import skipped_groups
    return skipped_groups(records(spark, sf_dir), "buyer", "purchase_date", "quantity", 30)


# ---------------------------------------------------------------- M1, M3-M5, M9-M12, S10, D5 (rows-only)
# All models take categories as target statistics (no vocabulary, any number of levels) and have the
# register's size.
RF_SIZE = dict(num_trees=100, max_depth=10)
_MODEL_CACHE: dict = {}


def _model_records(spark, sf_dir, with_year=False, materialize=False):
    """The columns of the price models. Encodings write their prepared rows themselves, so the join is not written before."""
    from agrolens.operators import models as M
    return records(spark, sf_dir, materialize, columns=["record_key", *M.BASE_CATEGORICAL, *M.BASE_NUMERIC, M.TARGET, *["purchase_date"] * with_year])


def _rf_model(spark, sf_dir, with_year=False):
    from agrolens.operators import models as M
    from agrolens.operators.target_model import fit_target_model
    k = ("rf", spark.sparkContext.applicationId, sf_dir, with_year)  # fitted objects live in one JVM
    if k not in _MODEL_CACHE:
        num = M.TIME_NUMERIC if with_year else M.BASE_NUMERIC
        _MODEL_CACHE[k] = fit_target_model(_model_records(spark, sf_dir, with_year), M.random_forest(**RF_SIZE),
                                           M.BASE_CATEGORICAL, num, with_year=with_year)
    return _MODEL_CACHE[k]


@register("rf_test_predictions")
def rf_test_predictions(spark, sf_dir):
    from agrolens.operators import models as M
    model, d = _rf_model(spark, sf_dir)
    s = model.score(d.where(F.col("is_test")))
    return s.select("record_key", *M.BASE_CATEGORICAL, *M.BASE_NUMERIC, "predicted_price", "actual_price")


@register("rf_test_metrics")
def rf_test_metrics(spark, sf_dir):
    from agrolens.operators.features import regression_metrics
    model, d = _rf_model(spark, sf_dir)
    return regression_metrics(model.score(d.where(F.col("is_test"))))


@register("rf_feature_importance")
def rf_feature_importance(spark, sf_dir):
    return _rf_model(spark, sf_dir)[0].importance(15)


@register("rf_residual_anomalies_top10")
def rf_residual_anomalies_top10(spark, sf_dir):
    from agrolens.operators.features import regression_metrics
    model, d = _rf_model(spark, sf_dir)
    m = regression_metrics(model.score(d.where(F.col("is_test"))))
    a = D.top_rows(D.residual_anomaly(model.score(d), m), "prediction_error", 10)
    return a.select("record_key", "county", "item_category", "manufacturer", "dealer",
                    "actual_price", "predicted_price", "price_difference")


@register("rf_next_year_specs")
def rf_next_year_specs(spark, sf_dir):
    """Price the test part's configurations as purchases of a future year (2026)."""
    from agrolens.operators import models as M
    model, d = _rf_model(spark, sf_dir, with_year=True)
    specs = d.where(F.col("is_test")).drop(M.TARGET).withColumn("purchase_year", F.lit(2026))
    return model.score(specs).select("record_key", *M.BASE_CATEGORICAL, "purchase_year", "predicted_price")


@register("rf_saved_model_scores", f"""
SELECT record_key, unit_price AS actual_price, true AS saved_equals_fitted
FROM records WHERE {_BUCKET_SQL} >= 80 AND unit_price IS NOT NULL
  AND county IS NOT NULL AND item_category IS NOT NULL AND manufacturer IS NOT NULL AND product_name IS NOT NULL
  AND model IS NOT NULL AND dealer IS NOT NULL AND quantity IS NOT NULL AND unit_subsidy IS NOT NULL""")
def rf_saved_model_scores(spark, sf_dir):
    """The fitted forest is saved, loaded back, and prices every test row alike."""
    import uuid

    from agrolens.operators import models as M
    from agrolens.operators.target_model import TargetModel, load_target_model
    from agrolens.session import scratch_path
    model, d = _rf_model(spark, sf_dir)
    path = scratch_path(spark, "rf-model-" + uuid.uuid4().hex[:12])
    model.save(path)
    loaded = M.load_or_train(path, lambda: model, load=lambda p: load_target_model(spark, p), save=TargetModel.save)
    test = d.where(F.col("is_test"))
    one = model.score(test).select("record_key", "actual_price", F.col("predicted_price").alias("a"))
    two = loaded.score(test).select(F.col("record_key").alias("k"), F.col("predicted_price").alias("b"))
    return one.join(two, F.col("record_key") == F.col("k"), "full").select(
        "record_key", "actual_price",
        F.coalesce(F.col("a") == F.col("b"), F.lit(False)).alias("saved_equals_fitted"))


@register("rf_model_checks", f"""
SELECT count(*) AS n_test, true AS beats_the_mean, true AS importances_sum_to_one
FROM records WHERE {_BUCKET_SQL} >= 80 AND unit_price IS NOT NULL
  AND county IS NOT NULL AND item_category IS NOT NULL AND manufacturer IS NOT NULL AND product_name IS NOT NULL
  AND model IS NOT NULL AND dealer IS NOT NULL AND quantity IS NOT NULL AND unit_subsidy IS NOT NULL""")
def rf_model_checks(spark, sf_dir):
    """M3 / M7 / M11 in values that do not depend on the trees."""
    model, d = _rf_model(spark, sf_dir)
    error = model.score(d.where(F.col("is_test"))).agg(
        F.count("predicted_price").alias("n_test"),
        (F.avg(F.abs(F.col("actual_price") - F.col("predicted_price")))
         < F.avg(F.abs(F.col("actual_price") - model.prior))).alias("beats_the_mean"))
    total = model.importance(1000).agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("importances_sum_to_one"))
    return error.crossJoin(F.broadcast(total))  # one row each


def _stopped_model(spark, sf_dir):
    """M4 at the register's size: 1000 rounds, patience 50, step 0.1, 31 leaves."""
    from agrolens.operators.target_model import fit_boosted_target_model
    k = ("stopped", spark.sparkContext.applicationId, sf_dir)
    if k not in _MODEL_CACHE:
        from agrolens.operators import models as M
        _MODEL_CACHE[k] = fit_boosted_target_model(records(
            spark, sf_dir, columns=["record_key", *M.PIPELINE_CATEGORICAL, *M.PIPELINE_NUMERIC, M.TARGET]))
    return _MODEL_CACHE[k]


@register("gbt_early_stopping_metrics")
def gbt_early_stopping_metrics(spark, sf_dir):
    """M4: leaf-wise boosting with early stopping, scored on the held-out part."""
    from agrolens.operators.features import regression_metrics
    model, d, best = _stopped_model(spark, sf_dir)
    m = regression_metrics(model.score(d.where(F.col("is_test"))))
    return m.withColumn("best_iteration", F.lit(best))


@register("gbt_early_stopping_rounds", f"""
SELECT count(*) AS n_held, true AS kept_round_is_minimum, true AS stopped_by_patience_or_limit, true AS error_is_that_of_the_rows,
       true AS at_most_31_leaves, true AS beats_the_mean
FROM records WHERE {_BUCKET_SQL} >= 80 AND unit_price IS NOT NULL""")
def gbt_early_stopping_rounds(spark, sf_dir):
    """M4 in values that do not depend on the trees: the held-out rows priced one to one; the kept round has the least
    error of the table; its error recomputed from the priced rows."""
    model, d, best = _stopped_model(spark, sf_dir)
    table = spark.createDataFrame(model.pipeline.errors, "round int, held_mse double, train_mse double")
    least = table.agg(F.min("held_mse").alias("least"), F.max("round").alias("last"),
                      F.max(F.when(F.col("round") == best, F.col("held_mse"))).alias("kept"),
                      F.max(F.when(F.col("round") == 0, F.col("held_mse"))).alias("mean"))
    leaves = model.pipeline.nodes(spark).where("feature = -1").groupBy("round").count().agg(F.max("count").alias("leaves"))
    held = model.score(d.where(F.col("is_test"))).agg(
        F.count("predicted_price").alias("n_held"), F.avg((F.col("actual_price") - F.col("predicted_price")) ** 2).alias("mse"))
    one = held.crossJoin(F.broadcast(least)).crossJoin(F.broadcast(leaves))  # one row each
    return one.select(
        "n_held", (F.col("kept") == F.col("least")).alias("kept_round_is_minimum"),
        ((F.col("last") - best == 50) | (F.col("last") == 1000)).alias("stopped_by_patience_or_limit"),
        (F.abs(F.col("mse") / F.col("kept") - 1) < 1e-6).alias("error_is_that_of_the_rows"),
        (F.col("leaves") <= 31).alias("at_most_31_leaves"), (F.col("kept") < F.col("mean")).alias("beats_the_mean"))


@register("importance_by_level_checks", """
SELECT 15::BIGINT AS n_top, true AS labels_name_column_and_level, true AS shares_add_up_to_the_columns, true AS sum_is_one""")
def importance_by_level_checks(spark, sf_dir):
    """The top labels of the early-stopped model, and all levels' shares summed up to the importance of their column."""
    model, _, _ = _stopped_model(spark, sf_dir)
    every = model.importance_by_level(None)
    sums = every.groupBy("column").agg(F.sum("importance").alias("own"))
    whole = model.importance(1000).select("feature", "importance")
    added = sums.join(whole, F.col("column") == F.col("feature"), "full").agg(
        F.min(F.coalesce(F.abs(F.col("own") - F.col("importance")) < 1e-9, F.lit(False))).alias("shares_add_up_to_the_columns"),
        (F.abs(F.sum("own") - 1) < 1e-9).alias("sum_is_one"))
    top = model.importance_by_level(15).agg(
        F.count(F.lit(1)).alias("n_top"),
        F.min(F.when(F.col("level").isNull(), F.col("label") == F.col("column"))
              .otherwise(F.col("label") == F.concat("column", F.lit(" ("), "level", F.lit(")")))).alias("labels_name_column_and_level"))
    return top.crossJoin(F.broadcast(added))  # one row each


@register("importance_by_level")
def importance_by_level(spark, sf_dir):
    """The 15 most important levels, as "column (level)"."""
    return _stopped_model(spark, sf_dir)[0].importance_by_level(15)


@register("gbt_regularised_metrics")
def gbt_regularised_metrics(spark, sf_dir):
    """M5 at the register's size: 300 rounds, depth 7, step 0.05, 80 % of rows and columns drawn for each tree."""
    from agrolens.operators import models as M
    from agrolens.operators.features import regression_metrics
    from agrolens.operators.target_model import fit_regularised_target_model
    k = ("regularised", spark.sparkContext.applicationId, sf_dir)
    if k not in _MODEL_CACHE:
        _MODEL_CACHE[k] = fit_regularised_target_model(_model_records(spark, sf_dir, True), M.BASE_CATEGORICAL, M.TIME_NUMERIC, with_year=True)
    model, d = _MODEL_CACHE[k]
    return regression_metrics(model.score(d.where(F.col("is_test"))))


def _target_encoded_sql() -> str:
    """Ordered statistics of the training part, level means of it for the test part."""
    from agrolens.operators.models import BASE_CATEGORICAL, TIME_NUMERIC
    cats, nums = BASE_CATEGORICAL, TIME_NUMERIC
    needed = " AND ".join(f"{c} IS NOT NULL" for c in [*cats, "quantity", "unit_subsidy", "unit_price"])
    ordered = ", ".join(
        f"(coalesce(sum(unit_price) OVER w_{c}, 0) + prior) / (count(unit_price) OVER w_{c} + 1) AS {c}_enc" for c in cats)
    windows = ", ".join(
        f"w_{c} AS (PARTITION BY {c} ORDER BY md5(record_key) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for c in cats)
    means = ",\n".join(f"l_{c} AS (SELECT {c}, sum(unit_price) AS s, count(unit_price) AS n FROM p WHERE NOT is_test GROUP BY {c})"
                       for c in cats)
    joins = " ".join(f"LEFT JOIN l_{c} ON t.{c} = l_{c}.{c}" for c in cats)
    looked_up = ", ".join(f"coalesce((l_{c}.s + prior) / (l_{c}.n + 1), prior) AS {c}_enc" for c in cats)
    rounded = ", ".join(f"round_even({c}_enc, 4) AS {c}_enc" for c in cats)
    return f"""
WITH p AS (SELECT *, coalesce(year(purchase_date), 2024) AS the_year, {_BUCKET_SQL} >= 80 AS is_test
           FROM records WHERE {needed}),
pr AS (SELECT avg(unit_price) AS prior FROM p WHERE NOT is_test),
{means},
e AS (
  SELECT * FROM (SELECT record_key, is_test, the_year, {ordered} FROM p, pr WHERE NOT is_test WINDOW {windows})
  UNION ALL
  SELECT t.record_key, true, t.the_year, {looked_up} FROM (SELECT * FROM p, pr WHERE is_test) t {joins})
SELECT record_key, is_test, the_year AS purchase_year, {rounded} FROM e"""


@register("target_encoded_rows", _target_encoded_sql())
def target_encoded_rows(spark, sf_dir):
    """M1/M6: the encoded feature rows that models are fitted on (train) and scored on (test)."""
    from agrolens.operators import models as M
    from agrolens.operators.target_model import encode_levels, encoded_rows
    rows, train, levels, prior = encoded_rows(_model_records(spark, sf_dir, True), M.BASE_CATEGORICAL, M.TIME_NUMERIC, with_year=True)
    test = encode_levels(rows.where(F.col("is_test")), levels, M.BASE_CATEGORICAL, prior)
    columns = ["record_key", "is_test", "purchase_year", *[f"{c}_enc" for c in M.BASE_CATEGORICAL]]
    return train.select(*columns).unionByName(test.select(*columns)).select(
        "record_key", "is_test", F.col("purchase_year").cast("long").alias("purchase_year"),
        *[F.bround(f"{c}_enc", 4).alias(f"{c}_enc") for c in M.BASE_CATEGORICAL])


ORDERS = 3


def _target_orders_sql() -> str:
    from agrolens.operators.models import BASE_CATEGORICAL as cats
    needed = " AND ".join(f"{c} IS NOT NULL" for c in [*cats, "quantity", "unit_subsidy", "unit_price"])
    stats = ", ".join(
        f"round_even((coalesce(sum(unit_price) OVER w_{c}_{o}, 0) + prior) / (count(unit_price) OVER w_{c}_{o} + 1), 4) AS {c}_enc{o}"
        for o in range(ORDERS) for c in cats)
    windows = ", ".join(
        f"w_{c}_{o} AS (PARTITION BY {c} ORDER BY md5(record_key || ':{o}') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        for o in range(ORDERS) for c in cats)
    return f"""
WITH p AS (SELECT * FROM records WHERE {needed} AND {_BUCKET_SQL} < 80),
pr AS (SELECT avg(unit_price) AS prior FROM p)
SELECT record_key, {stats} FROM p, pr WINDOW {windows}"""


@register("target_order_rows", _target_orders_sql())
def target_order_rows(spark, sf_dir):
    """M6: every training row's ordered target statistics in each of the seeded orders."""
    from agrolens.operators import models as M
    from agrolens.operators.features import ordered_target_orders, split_train_test
    rows = split_train_test(M.prepare(_model_records(spark, sf_dir), M.BASE_CATEGORICAL, M.BASE_NUMERIC))
    out = ordered_target_orders(rows.where(~F.col("is_test")), M.BASE_CATEGORICAL, M.TARGET, orders=ORDERS)
    return out.select("record_key", *[F.bround(c, 4).alias(c) for c in out.columns if c != "record_key"])


def _target_model(spark, sf_dir):
    """M6 at the register's size: 500 rounds, depth 7, step 0.05."""
    from agrolens.operators import models as M
    from agrolens.operators.target_model import fit_ordered_target_model
    k = ("target", spark.sparkContext.applicationId, sf_dir)
    if k not in _MODEL_CACHE:
        _MODEL_CACHE[k] = fit_ordered_target_model(_model_records(spark, sf_dir, True), M.BASE_CATEGORICAL, M.TIME_NUMERIC, with_year=True, orders=ORDERS)
    return _MODEL_CACHE[k]


@register("gbt_target_encoded_metrics")
def gbt_target_encoded_metrics(spark, sf_dir):
    """M6: boosting on target statistics in several orders, scored on the test part."""
    from agrolens.operators.features import regression_metrics
    model, d = _target_model(spark, sf_dir)
    return regression_metrics(model.score(d.where(F.col("is_test"))))


@register("target_model_checks", f"""
SELECT count(*) AS n_specs, true AS saved_equals_fitted, true AS beats_the_mean
FROM records WHERE {_BUCKET_SQL} >= 80 AND unit_price IS NOT NULL
  AND county IS NOT NULL AND item_category IS NOT NULL AND manufacturer IS NOT NULL AND product_name IS NOT NULL
  AND model IS NOT NULL AND dealer IS NOT NULL AND quantity IS NOT NULL AND unit_subsidy IS NOT NULL""")
def target_model_checks(spark, sf_dir):
    """Test rows without their price are priced one to one for 2026; the model that was
    saved and loaded prices every row alike; its test error is below that of the mean price."""
    import uuid

    from agrolens.operators import models as M
    from agrolens.operators.target_model import load_boosted_target_model
    from agrolens.session import scratch_path
    model, d = _target_model(spark, sf_dir)
    path = scratch_path(spark, "target-model-" + uuid.uuid4().hex[:12])
    model.save(path)
    test = d.where(F.col("is_test"))
    specs = test.drop(M.TARGET).withColumn("purchase_year", F.lit(2026))
    one = model.score(specs).select("record_key", F.col("predicted_price").alias("a"))
    two = load_boosted_target_model(spark, path).score(specs).select(F.col("record_key").alias("k"), F.col("predicted_price").alias("b"))
    same = one.join(two, F.col("record_key") == F.col("k"), "full").agg(
        F.count("a").alias("n_specs"), F.min(F.coalesce(F.col("a") == F.col("b"), F.lit(False))).alias("saved_equals_fitted"))
    error = model.score(test).agg((F.avg(F.abs(F.col("actual_price") - F.col("predicted_price")))
                                   < F.avg(F.abs(F.col("actual_price") - model.prior))).alias("beats_the_mean"))
    return same.crossJoin(F.broadcast(error))  # one row each


_IF_FEATURES = ["unit_price", "unit_subsidy", "total_subsidy", "quantity"]


_HOT_COLS = ["county", "item_category", "manufacturer", "model", "dealer", "serial_no"]
_HOT_SQL = f"""
WITH p AS (SELECT record_key, {_BUCKET_SQL} >= 80 AS is_test, CASE WHEN substr(record_key, 1, 1) <> '0' THEN county END AS c0,
             item_category AS c1, manufacturer AS c2, model AS c3, dealer AS c4, serial_no AS c5 FROM records),
e AS (SELECT record_key, is_test, unnest([0, 1, 2, 3, 4, 5]) AS col, unnest([c0, c1, c2, c3, c4, c5]) AS level FROM p),
lv AS (SELECT DISTINCT col, level FROM e WHERE NOT is_test),
first AS (SELECT col, min(level) AS level FROM lv GROUP BY col),
v AS (SELECT lv.col, lv.level, row_number() OVER (ORDER BY lv.col, lv.level NULLS LAST) - 1 AS idx
      FROM lv JOIN first ON lv.col = first.col WHERE lv.level IS NULL OR lv.level > first.level)"""


def _hot_rows(spark, sf_dir):
    """Records with some counties missing, split in training and test part."""
    from agrolens.operators.features import split_train_test
    r = records(spark, sf_dir, columns=["record_key", *_HOT_COLS]).withColumn("county", F.when(F.substring("record_key", 1, 1) != "0", F.col("county")))
    return split_train_test(r.select("record_key", *_HOT_COLS))


@register("onehot_aligned_rows", _HOT_SQL + """
SELECT p.record_key, p.is_test, coalesce(string_agg(idx::VARCHAR, ',' ORDER BY idx), '') AS entries
FROM p LEFT JOIN e ON e.record_key = p.record_key LEFT JOIN v ON v.col = e.col AND v.level IS NOT DISTINCT FROM e.level
GROUP BY p.record_key, p.is_test""")
def onehot_aligned_rows(spark, sf_dir):
    """M1 + J6: one-hot entries of every row by the vocabulary of the training part: first levels dropped, missing values
    as a level, levels that only the test part holds without entry."""
    from agrolens.operators.vocabulary import fit_vocabulary, one_hot
    rows = _hot_rows(spark, sf_dir)
    v = fit_vocabulary(rows.where(~F.col("is_test")), _HOT_COLS)
    return one_hot(rows, v, _HOT_COLS, "record_key").select(
        "record_key", "is_test", F.array_join(F.col("onehot").cast("array<string>"), ",").alias("entries"))


@register("onehot_unknown_levels", _HOT_SQL + """
SELECT ['county', 'item_category', 'manufacturer', 'model', 'dealer', 'serial_no'][col + 1] AS name, level, count(*) AS n_rows
FROM e WHERE is_test AND NOT EXISTS (SELECT 1 FROM lv WHERE lv.col = e.col AND lv.level IS NOT DISTINCT FROM e.level)
GROUP BY col, level""")
def onehot_unknown_levels(spark, sf_dir):
    """Levels of the test part that the training part does not hold."""
    from agrolens.operators.vocabulary import unknown_levels
    rows = _hot_rows(spark, sf_dir)
    return unknown_levels(rows.where(F.col("is_test")), rows.where(~F.col("is_test")), _HOT_COLS)


@register("iforest_scores")
def iforest_scores(spark, sf_dir):
    from agrolens.operators.isolation_forest import isolation_forest
    r = records(spark, sf_dir, columns=["record_key", *_IF_FEATURES])
    return isolation_forest(r, _IF_FEATURES, n_trees=200, contamination=0.02)


@register("iforest_summary", """
SELECT count(*) AS n_rows, true AS scores_in_range, true AS flags_within_share FROM records""")
def iforest_summary(spark, sf_dir):
    """D5 in numbers that do not depend on the trees: every row scored, scores in (0, 1), at
    most 2 % of the rows flagged."""
    flagged = F.sum(F.col("iforest_anomaly").cast("int"))
    return iforest_scores(spark, sf_dir).agg(
        F.count("iforest_score").alias("n_rows"),
        ((F.min("iforest_score") > 0) & (F.max("iforest_score") < 1)).alias("scores_in_range"),
        (flagged <= 0.02 * F.count(F.lit(1))).alias("flags_within_share"))


@register("iforest_saved_model", """
SELECT count(*) AS n_rows, true AS saved_equals_fitted, true AS flags_within_share FROM records""")
def iforest_saved_model(spark, sf_dir):
    """The forest that was saved and loaded scores and flags every row as the fitted one does."""
    import uuid

    from agrolens.operators.isolation_forest import fit_isolation_forest, load_isolation_forest
    from agrolens.session import scratch_path
    r = records(spark, sf_dir, columns=["record_key", *_IF_FEATURES])
    model = fit_isolation_forest(r, _IF_FEATURES)
    path = scratch_path(spark, "iforest-" + uuid.uuid4().hex[:12])
    model.save(spark, path)
    one = model.score(r).select("record_key", F.col("iforest_score").alias("a"), F.col("iforest_anomaly").alias("x"))
    two = load_isolation_forest(spark, path).score(r).select(
        F.col("record_key").alias("k"), F.col("iforest_score").alias("b"), F.col("iforest_anomaly").alias("y"))
    same = (F.col("a") == F.col("b")) & (F.col("x") == F.col("y"))
    return one.join(two, F.col("record_key") == F.col("k"), "full").agg(
        F.count("a").alias("n_rows"), F.min(F.coalesce(same, F.lit(False))).alias("saved_equals_fitted"),
        (F.sum(F.col("x").cast("int")) <= 0.02 * F.count(F.lit(1))).alias("flags_within_share"))


@register("record_ids_after_shuffle", """
SELECT count(*) AS n_rows, count(*) AS n_ids, 1::BIGINT AS first_id, count(*) AS last_id FROM records""")
def record_ids_after_shuffle(spark, sf_dir):
    """Rows numbered after a shuffle that AQE may coalesce keep every row and id."""
    from agrolens.functions.clean import with_row_index
    shuffled = records(spark, sf_dir, columns=["record_key", "county"]).repartition(F.col("county"))
    return with_row_index(shuffled).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("record_id").alias("n_ids"),
        F.min("record_id").alias("first_id"), F.max("record_id").alias("last_id"))


@register("source_order", """
SELECT count(*) AS n_rows, count(*) AS n_in_order FROM records""")
def source_order(spark, sf_dir):
    """Numbered rows, shuffled and brought back into source order, lie at their own numbers."""
    from agrolens.functions.clean import with_row_index
    from agrolens.sources.sinks import restore_order
    numbered = with_row_index(records(spark, sf_dir, columns=["record_key", "county"]))
    back = restore_order(numbered.repartition(F.col("county")), "record_id").withColumnRenamed("record_id", "was")
    return with_row_index(back).agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.sum((F.col("was") == F.col("record_id")).cast("long")).alias("n_in_order"))


@register("boosting_rows", """
SELECT CASE WHEN substr(record_key, 1, 1) = '1' THEN 'NA' ELSE item_category END AS item_category,
       count(*) AS n_rows, sum(CASE WHEN substr(record_key, 1, 1) = '0' THEN 1.0::DOUBLE ELSE quantity END) AS quantity
FROM records WHERE substr(record_key, 1, 1) <> '2' AND unit_price IS NOT NULL GROUP BY 1""")
def boosting_rows(spark, sf_dir):
    """M4's training rows: missing quantity is 1, a missing category is 'NA', and only rows
    without a price are dropped (nulls injected by the record key)."""
    from agrolens.operators import models as M
    first = F.substring("record_key", 1, 1)
    r = records(spark, sf_dir)
    for digit, c in (("0", "quantity"), ("1", "item_category"), ("2", M.TARGET)):
        r = r.withColumn(c, F.when(first != digit, F.col(c)))
    rows = M.prepare(r, ["item_category"], ["quantity"], fills={"quantity": 1.0}, required=[M.TARGET])
    return rows.groupBy("item_category").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("quantity"))


@register("iforest_alert")
def iforest_alert(spark, sf_dir):
    """D7 as in the register: alert when more than 10 rows are isolation-forest anomalies."""
    return D.alert_if(iforest_scores(spark, sf_dir), "iforest_anomaly", 10)


# ---------------------------------------------------------------- more A16 / A20 / streaming
@register("township_top20", """
SELECT township, count(*) AS record_count FROM records WHERE township IS NOT NULL
GROUP BY township ORDER BY record_count DESC, township LIMIT 20""")
def township_top20(spark, sf_dir):
    return A.top_by_count(records(spark, sf_dir), "township", 20)


@register("top_performers_top_category", f"""
SELECT item_category, rank, manufacturer, model, round_even(average_price, 2) AS average_price,
       round_even(sales_count, 2) AS sales_count, round_even(max_central_subsidy, 2) AS max_central_subsidy
FROM (SELECT *, row_number() OVER (PARTITION BY item_category ORDER BY average_price DESC, manufacturer, model) AS rank
      FROM (SELECT item_category, manufacturer, model, avg(unit_price) AS average_price,
                   sum(quantity) AS sales_count, max(unit_subsidy) AS max_central_subsidy
            FROM records WHERE item_category = (SELECT item_category FROM ({_TOP6_SQL}) t LIMIT 1)
              AND manufacturer IS NOT NULL AND model IS NOT NULL
            GROUP BY item_category, manufacturer, model) g) t
WHERE rank <= 5""")
def top_performers_top_category(spark, sf_dir):
    """A20 as the register calls it: one category (here the most frequent one), top 5."""
    r = records(spark, sf_dir)
    top1 = A.top_categories(r, n=1).select("item_category")
    return A.top_performers(r.join(F.broadcast(top1), "item_category", "left_semi"), n=5)


@register("streamed_html_roundtrip", _CLEAN_SQL)
def streamed_html_roundtrip(spark, sf_dir):
    """Streaming ingestion: the record pages land as files, an available-now stream extracts
    their tables (a few files per micro-batch) into an append-only table, which is read back
    and cleaned."""
    import uuid

    from agrolens.session import release_shuffles, scratch_path
    from agrolens.streaming.page_ingest import land_pages, start_ingest
    base = scratch_path(spark, "stream-" + uuid.uuid4().hex[:8])
    pages = _record_pages(spark, sf_dir).withColumn("url", F.lit(None).cast("string"))
    land_pages(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), f"{base}/pages")
    release_shuffles(spark)
    q = start_ingest(spark, f"{base}/pages", f"{base}/rows", f"{base}/_checkpoint", max_files_per_trigger=4)
    q.awaitTermination()
    return _pages_to_records(spark.read.parquet(f"{base}/rows"))
