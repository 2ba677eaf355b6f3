"""Each operator's query over the given tables, and the same result in SQL.

The SQL works on the columns the filings were rendered from wherever it can, so it
does not repeat the parsing it checks.
"""

from pyspark.sql import functions as F

import docketflow as d
from docketflow.functions import fields
from docketflow.schemas import FILING
from docketflow.session import work_path

from . import adapters as a
from .adapters import ATTEMPTS_SQL, FILINGS_SQL, INDEX_PAGES_SQL

QUERIES, ORACLES = {}, {}

FILING_COLUMNS = ", ".join(FILING.fieldNames())
ANNUAL = "upper(form_type) in ('10-K', '10-K/A')"


def query(sql=None, *, ctes=FILINGS_SQL):
    """Register a query under its function name, with its SQL."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = f"with {ctes.strip()}\n{sql.strip()}" if ctes else sql.strip()
        return fn

    return register


def _staged(spark, df, label):
    """`df` written once to the shared working folder; the folder."""
    path = work_path(spark, label)
    df.write.parquet(path)
    return path


# --- scans, sources, sinks ------------------------------------------------------


@query(
    """
select sourcefile, row_number() over (partition by sourcefile order by o_orderkey) - 1 as line_no,
  concat(rpad(company_name, 62, ' '), rpad(form_type, 12, ' '), rpad(cik, 12, ' '),
    rpad(date_filed, 12, ' '), filename) as line
from a1
"""
)
def scan_index(spark, sf_dir):
    return d.scan_index(spark, a.landed_listings(spark, sf_dir))


@query(
    """
select company_name, form_type, cik, date_filed, filename, year, quarter, sourcefile,
  row_number() over (partition by sourcefile order by o_orderkey) - 1 as line_no
from a1 qualify form_type not like '% %' and date_filed <> '------------'
"""
)
def scan_index_recursive(spark, sf_dir):
    path = a.landed_listings(spark, sf_dir, extension="IDX")
    return d.parse_index(d.scan_index(spark, path, recursive=True))


@query(
    """
select company_name, form_type, cik, date_filed, filename, cast(year as varchar) as year,
  quarter, sourcefile, cast(line_no as varchar) as line_no from a1
"""
)
def scan_csv_text(spark, sf_dir):
    path = work_path(spark, "filings") + ".csv"
    d.write_table(a.filings(spark, sf_dir), path)
    return d.scan_table(spark, path)


@query("select cast(doc_id as varchar) as doc_id, text, lang, source from documents", ctes=None)
def scan_csv_line_breaks(spark, sf_dir):
    """Documents, whose texts hold line breaks and quotes, as CSV and back in pieces."""
    path = work_path(spark, "documents") + ".csv"
    d.write_table(a.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), path)
    return d.scan_table(spark, path)


@query(f"select {FILING_COLUMNS} from a1".replace("form_type, ", ""))
def optional_form_filter(spark, sf_dir):
    """A table without forms passes the filter on forms as it is."""
    return d.keep_annual_forms(a.filings(spark, sf_dir).drop("form_type"), optional=True)


@query(f"select {FILING_COLUMNS} from a1")
def scan_parquet(spark, sf_dir):
    path = work_path(spark, "filings") + ".parquet"
    d.write_table(a.filings(spark, sf_dir), path)
    return d.scan_table(spark, path)


@query(
    """
select cast(event_id as varchar) as event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, user_id::varchar as user_id,
  event_type, printf('%.6e', value) as value, props from events
""",
    ctes=None,
)
def sink_roundtrip_csv(spark, sf_dir):
    path = work_path(spark, "events")
    d.write_table(a.table(spark, sf_dir, "events"), path, "csv")
    # Numbers and times are compared in one notation; the text read back holds their value.
    value = F.format_string("%.6e", F.col("value").cast("double"))
    ts = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return d.scan_table(spark, path, "csv").withColumns({"value": value, "ts": ts})


@query("select doc_id, text, lang, source, n_chars from documents", ctes=None)
def sink_roundtrip_parquet(spark, sf_dir):
    path = work_path(spark, "documents")
    d.write_table(a.table(spark, sf_dir, "documents"), path, "parquet")
    return d.scan_table(spark, path, "parquet")


@query(f"select {FILING_COLUMNS} from a1 where {ANNUAL}".replace("form_type,", "upper(form_type) as form_type,"))
def sink_ignore_existing(spark, sf_dir):
    path = work_path(spark, "filings") + ".parquet"
    d.write_table(d.keep_annual_forms(a.filings(spark, sf_dir)), path, if_exists="skip")
    d.write_table(a.filings(spark, sf_dir), path, if_exists="skip")
    return d.scan_table(spark, path)


@query("select distinct concat('sourcefile=', sourcefile) as folder, true as has_bytes from a1")
def list_parts(spark, sf_dir):
    path = work_path(spark, "parts")
    spread = a.filings(spark, sf_dir).hint("rebalance", "sourcefile")
    spread.write.partitionBy("sourcefile").parquet(path)
    folder = F.element_at(F.split("path", "/"), -2)
    return (
        d.list_parts(spark, path)
        .groupBy(folder.alias("folder"))
        .agg((F.sum("bytes") > 0).alias("has_bytes"))
    )


@query(f"select {FILING_COLUMNS} from a1")
def compact_parts(spark, sf_dir):
    source, target = work_path(spark, "parts"), work_path(spark, "compacted")
    d.write_parts(a.filings(spark, sf_dir), source, rows_per_part=500)
    d.compact(spark, source, target, compression="zstd")
    return spark.read.parquet(target)


@query(
    """
select printf('%06d', part) as part, count(*) as records, count(*) filter (where ok) as successes,
  min(event_id) as first_event, max(event_id) as last_event
from (
  select event_id, event_type <> 'error' as ok,
    cast(coalesce(sum(case when event_type <> 'error' then 1 else 0 end) over (
      order by event_id rows between unbounded preceding and 1 preceding), 0) as bigint) // 200 as part
  from events)
group by part
""",
    ctes=None,
)
def write_parts(spark, sf_dir):
    ok = F.col("event_type") != "error"
    numbered = d.assign_part(a.table(spark, sf_dir, "events"), "event_id", ok, 200)
    path = work_path(spark, "parts")
    d.write_parts(numbered, path, folders=True)
    written = d.scan_parts(spark, path, _without_part(numbered))
    return written.groupBy("part").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(ok).alias("successes"),
        F.min("event_id").alias("first_event"),
        F.max("event_id").alias("last_event"),
    )


def _without_part(df):
    return ", ".join(f"{name} {dtype}" for name, dtype in df.dtypes if name != "part")


@query(
    f"""
select cik, cast(year(order_date) as varchar) as year,
  replace(string_split(filename, '/')[4], '.txt', '') as accession, company_name, filename
from a1 where {ANNUAL} and dated
"""
)
def write_documents(spark, sf_dir):
    path = work_path(spark, "documents")
    annual = d.filter_annual(a.filings(spark, sf_dir))
    d.write_documents(annual, path)
    return d.scan_documents(spark, path, columns="company_name string, filename string")


@query(
    """
select y.pos, y.year, q.quarter, concat(y.year, '_', q.quarter, '_company.idx') as filename,
  concat('https://www.sec.gov/Archives/edgar/full-index/', y.year, '/', q.quarter,
    '/company.idx') as url
from (select case when l_partkey % 3 = 0 then cast(year(l_shipdate) as integer)
        else cast(1000 + l_partkey % 900 as integer) end as year, min(l_orderkey) as pos
      from lineitem group by 1) y,
  (values ('QTR1'), ('QTR2'), ('QTR3'), ('QTR4')) q(quarter)
where not exists (
  select 1 from a1 where a1.sourcefile = concat(y.year, '_', q.quarter, '_company.idx'))
"""
)
def plan_periods(spark, sf_dir):
    shipped = a.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("pos"),
        F.when(F.col("l_partkey") % 3 == 0, F.year("l_shipdate"))
        .otherwise(F.col("l_partkey") % 900 + 1000).alias("year"),
    )
    landed = a.filings(spark, sf_dir).select(F.col("sourcefile").alias("filename"))
    return d.plan_periods(shipped, None, landed)


@query(
    """
select 'all' as input, count(*) > 0 as written, count(*) as n_rows from a1
union all
select 'none', count(*) > 0, count(*) from a1 where form_type = 'NO SUCH FORM'
"""
)
def empty_guard(spark, sf_dir):
    base = a.filings(spark, sf_dir)
    inputs = {"all": base, "none": base.filter(F.col("form_type") == "NO SUCH FORM")}
    results = []
    for name, df in inputs.items():
        path = work_path(spark, "guarded") + ".parquet"
        written = d.write_table(df, path)
        kept = d.scan_table(spark, path) if d.output_exists(spark, path) else df.limit(0)
        results.append(
            kept.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("input"), F.lit(written).alias("written"), "n_rows"
            )
        )
    return results[0].unionByName(results[1])


# --- projections and scalar functions ---------------------------------------------


@query(
    f"""
select {FILING_COLUMNS} from a1
where form_type not like '% %' and date_filed <> '------------'
"""
)
def parse_index(spark, sf_dir):
    return d.parse_index(a.index_lines(spark, sf_dir))


@query(f"select {FILING_COLUMNS} from a1".replace("line_no", "line_no + 9 as line_no"))
def parse_index_fixed(spark, sf_dir):
    return d.parse_index(a.index_lines(spark, sf_dir, first=9), layout="fixed")


@query("select sourcefile, count(*) as data_lines from a1 group by sourcefile")
def index_line_filter(spark, sf_dir):
    noise = F.array(
        F.lit(""),
        F.lit(" \t\x1f"),
        F.lit("-" * 40),
        F.lit("Company Name      Form Type   CIK"),
        F.lit("COMPANY NAME"),
    )
    lines = a.index_lines(spark, sf_dir).select(
        "sourcefile", F.explode(F.concat(F.array("line"), noise)).alias("line")
    )
    kept = lines.filter(d.is_data_line(F.col("line")))
    return kept.groupBy("sourcefile").agg(F.count(F.lit(1)).alias("data_lines"))


@query(f"select {FILING_COLUMNS} from a1")
def strip_columns(spark, sf_dir):
    base = a.filings(spark, sf_dir)
    text = {name for name, dtype in base.dtypes if dtype == "string"}
    return d.strip_all(
        base.select(*[a.padded(F.col(c)).alias(c) if c in text else F.col(c) for c in base.columns])
    )


@query(
    """
select o_orderkey, case when o_orderstatus <> 'P' then year end as year,
  case when o_orderstatus <> 'P' then quarter end as quarter
from a1
"""
)
def period_from_name(spark, sf_dir):
    name = (
        F.when(F.col("o_orderstatus") == "P", F.concat("sourcefile", F.lit(".bak")))
        .when(F.col("o_orderstatus") == "F", F.lower("sourcefile"))
        .otherwise(F.concat(F.lit("backup_"), "sourcefile"))
    )
    return a.order_filings(spark, sf_dir).select(
        "o_orderkey", d.period_year(name).alias("year"), d.period_quarter(name).alias("quarter")
    )


@query("select o_orderkey, cik from a1")
def clean_cik(spark, sf_dir):
    suffix = F.when(F.col("o_orderstatus") == "F", ".0").otherwise(" ")
    return a.order_filings(spark, sf_dir).select(
        "o_orderkey", d.clean_cik(F.concat("cik", suffix)).alias("cik")
    )


@query(
    """
select o_orderkey, case when o_orderstatus <> 'P' then lpad(cik, 10, '0') else '' end as cik
from a1
"""
)
def normalize_cik(spark, sf_dir):
    raw = F.when(
        F.col("o_orderstatus") != "P",
        F.concat(F.lit(" CIK-"), F.lpad("cik", 10, "0"), F.lit(".0\t")),
    )
    return a.order_filings(spark, sf_dir).select("o_orderkey", d.normalize_cik(raw).alias("cik"))


@query("select o_orderkey, upper(form_type) as form_type from a1")
def normalize_form(spark, sf_dir):
    return a.order_filings(spark, sf_dir).select(
        "o_orderkey", d.normalize_form(a.padded(F.col("form_type"))).alias("form_type")
    )


@query(
    """
select o_orderkey,
  case o_orderpriority when '4-NOT SPECIFIED' then make_date(year(order_date), 1, 1)
    when '5-LOW' then case when dated then order_date end
    else order_date end as filed
from a1
"""
)
def parse_date(spark, sf_dir):
    layout = F.col("o_orderpriority")
    day = F.col("order_date")
    text = (
        F.when(layout == "1-URGENT", F.date_format(day, "MM/dd/yyyy"))
        .when(layout == "2-HIGH", F.date_format(day, "yyyyMMdd"))
        .when((layout == "3-MEDIUM") & (F.col("o_orderstatus") == "F"),
              F.date_format(day, "MMM d, yyyy"))
        .when(layout == "3-MEDIUM", F.concat(day.cast("string"), F.lit("T13:05:00")))
        .when(layout == "4-NOT SPECIFIED", F.date_format(day, "yyyy"))
        .otherwise(F.col("date_filed"))
    )
    return a.order_filings(spark, sf_dir).select(
        "o_orderkey", d.parse_date(a.padded(text)).alias("filed")
    )


@query(
    """
select o_orderkey, cast(year(order_date) as integer) as year,
  strftime(order_date, '%Y-%m-%d') as date_filed
from a1 where dated
"""
)
def filing_year(spark, sf_dir):
    period = a.order_filings(spark, sf_dir).withColumn("year", F.lit(None).cast("int"))
    return d.add_filing_year(period).select("o_orderkey", "year", "date_filed")


@query(
    """
select o_orderkey, case when dated then order_date end as date_filed,
  case when dated then cast(month(order_date) as integer) end as month,
  case when dated then cast(year(order_date) as integer) end as year
from a1
"""
)
def month_year(spark, sf_dir):
    return d.add_month_year(a.order_filings(spark, sf_dir)).select(
        "o_orderkey", "date_filed", "month", "year"
    )


@query(
    """
select o_orderkey, case month(order_date) when 1 then 'Jan' when 2 then 'Feb' when 3 then 'Mar'
  when 4 then 'Apr' when 5 then 'May' when 6 then 'Jun' when 7 then 'Jul' when 8 then 'Aug'
  when 9 then 'Sept' when 10 then 'Oct' when 11 then 'Nov' when 12 then 'Dec' end as label
from a1
"""
)
def month_name(spark, sf_dir):
    return a.order_filings(spark, sf_dir).select(
        "o_orderkey", fields.month_name(F.month("order_date")).alias("label")
    )


@query(
    """
select o_orderkey, case when o_orderstatus <> 'P' then cast(year as bigint) end as year from a1
"""
)
def coerce_year(spark, sf_dir):
    suffix = (
        F.when(F.col("o_orderstatus") == "P", "x")
        .when(F.col("o_orderstatus") == "F", ".0 ")
        .otherwise("")
    )
    return a.order_filings(spark, sf_dir).select(
        "o_orderkey", d.coerce_year(F.concat("year", suffix)).alias("year")
    )


_STEM = "replace(string_split(filename, '/')[4], '.txt', '')"


@query(
    f"""
select o_orderkey, case when o_orderstatus <> 'P' then cik end as cik,
  case when o_orderstatus <> 'P' then {_STEM} end as accession,
  case when o_orderstatus <> 'P' then concat('https://www.sec.gov/Archives/edgar/data/', cik, '/',
    replace({_STEM}, '-', ''), '/', {_STEM}, '-index.htm') end as index_url
from a1
"""
)
def accession_parts(spark, sf_dir):
    spaced = F.regexp_replace("filename", "/", " / ")
    return (
        a.asked_filings(spark, sf_dir)
        .select("o_orderkey", d.accession_parts(spaced).alias("p"))
        .select("o_orderkey", "p.cik", "p.accession", "p.index_url")
    )


@query(
    """
select o_orderkey,
  case when o_orderstatus = 'P' then 'none' when filename like '%.txt' then 'direct'
    else 'index' end as kind,
  case when o_orderstatus = 'P' then null
    when filename like '%.txt' then concat('https://www.sec.gov/Archives/',
      replace(filename, '.txt', '.TXT'))
    else concat('https://www.sec.gov/Archives/', filename, '/index.html') end as url,
  case when o_orderstatus = 'P' then concat('⚠️ Invalid path: a/', o_orderkey) end as status
from a1
"""
)
def fetch_target(spark, sf_dir):
    name = F.concat(
        F.when(F.col("o_orderstatus") == "F", "/").otherwise(""),
        F.regexp_replace("filename", r"\.txt$", ".TXT"),
    )
    direct = F.when(F.col("filename").endswith(".txt"), name).otherwise(F.col("filename"))
    return (
        a.asked_filings(spark, sf_dir)
        .select("o_orderkey", d.fetch_target(direct).alias("t"))
        .select("o_orderkey", "t.kind", "t.url", "t.status")
    )


@query(
    """
select page_id, url as a_full, concat('https://www.sec.gov/', url) as b_full,
  concat('https://www.sec.gov/p/', page_id) as a_rooted,
  concat('https://www.sec.gov/p/', page_id) as b_rooted,
  concat('https://www.sec.gov/p/', page_id) as a_bare
from pages
""",
    ctes=None,
)
def absolute_url(spark, sf_dir):
    rooted = F.concat(F.lit("/p/"), "page_id")
    return a.table(spark, sf_dir, "pages").select(
        "page_id",
        d.absolute_url(F.col("url")).alias("a_full"),
        d.absolute_url(F.col("url"), "B").alias("b_full"),
        d.absolute_url(rooted).alias("a_rooted"),
        d.absolute_url(F.concat(F.lit("/"), rooted), "B").alias("b_rooted"),
        d.absolute_url(F.concat(F.lit(" p/"), "page_id")).alias("a_bare"),
    )


@query(
    """
select o_orderkey, concat('https://www.sec.gov/Archives/', filename) as url from a1
"""
)
def fix_viewer_url(spark, sf_dir):
    prefix = F.when(F.col("o_orderstatus") == "F", "https://www.sec.gov/ix?doc=/Archives/")
    link = F.concat(F.coalesce(prefix, F.lit("https://www.sec.gov/Archives/")), "filename")
    return a.order_filings(spark, sf_dir).select("o_orderkey", d.fix_viewer_url(link).alias("url"))


@query(
    f"""
select o_orderkey, cik as key_cik,
  case when o_orderstatus = 'F' then 'unknown' else cast(year as varchar) end as key_year,
  case when o_orderstatus = 'P' then 'unknown' else {_STEM} end as key_accession
from a1
"""
)
def document_keys(spark, sf_dir):
    filed = a.asked_filings(spark, sf_dir).withColumn(
        "year", F.when(F.col("o_orderstatus") != "F", F.col("year"))
    )
    return d.document_keys(filed).select("o_orderkey", "key_cik", "key_year", "key_accession")


@query(f"select {FILING_COLUMNS} from a1")
def snake_columns(spark, sf_dir):
    spoken = a.filings(spark, sf_dir)
    return d.snake_columns(spoken.toDF(*[c.replace("_", " ").title() for c in spoken.columns]))


# Element by element, as this engine's patterns have no back-references.
_HIDDEN_SQL = "|".join(
    f"<{e}(?:\\s[^>]*)?>.*?(?:</{e}\\s*>|\\z)"
    for e in ("script", "style", "header", "footer", "nav", "noscript")
)
_CLEAN_SQL = f"""
with visible as (
  select page_id, regexp_replace(html, '(?is)<!--.*?-->|{_HIDDEN_SQL}', chr(10), 'g') as t
  from pages),
bare as (
  select page_id, regexp_replace(
    regexp_replace(t, '(?is)\\A.*?<body(?:\\s[^>]*)?>|</body\\s*>.*\\z', '', 'g'),
    '(?s)</?[A-Za-z!](?:[^>"'']|"[^"]*"|''[^'']*'')*>', chr(10), 'g') as t
  from visible),
decoded as (
  select page_id, regexp_replace(replace(replace(replace(replace(replace(replace(t,
    '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', chr(160)),
    '&amp(;|\\b)', '&', 'g') as t
  from bare)
select page_id, array_to_string(list_filter(list_transform(
  string_split_regex(t, '[\\n\\r\\x0b\\f\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]'),
  lambda x: trim(x, chr(9) || chr(31) || chr(32) || chr(160))), lambda x: x <> ''), chr(10)) as cleaned_text
from decoded
"""


@query(_CLEAN_SQL, ctes=None)
def clean_nested_pages(spark, sf_dir):
    """Pages with up to eight elements inside each other at the beginning of their body."""
    depth = (F.col("page_id") % 9).cast("int")
    nest = F.concat(F.lit("$0"), F.repeat(F.lit("<nav>menu"), depth), F.repeat(F.lit("</nav >"), depth))
    nested = F.regexp_replace("html", F.lit("(?i)<body[^>]*>"), nest)
    pages = a.table(spark, sf_dir, "pages").withColumn("html", nested)
    return d.clean_pages(pages).select("page_id", "cleaned_text")


@query(_CLEAN_SQL, ctes=None)
def clean_pages(spark, sf_dir):
    pages = a.spread(a.table(spark, sf_dir, "pages").select("page_id", "html"))
    # What is inside a menu does not count, another menu included.
    nested = F.replace("html", F.lit("<nav>"), F.lit("<nav>a<nav class='b'>b</nav>c<header>d</header>"))
    return d.clean_pages(pages.withColumn("html", nested)).select("page_id", "cleaned_text")


# --- filters ----------------------------------------------------------------------

_ANNUAL_SQL = f"""
select company_name, upper(form_type) as form_type, cik, strftime(order_date, '%Y-%m-%d') as date_filed,
  filename, cast(year(order_date) as integer) as year, quarter, sourcefile, line_no
from a1 where {ANNUAL} and dated
"""


@query(_ANNUAL_SQL)
def filter_annual(spark, sf_dir):
    return d.filter_annual(a.filings(spark, sf_dir))


@query(f"select {FILING_COLUMNS} from a1 where date_filed <> '------------'")
def drop_sentinel_dates(spark, sf_dir):
    return d.drop_sentinel_dates(a.filings(spark, sf_dir))


@query(
    f"""
select o_orderkey, upper(form_type) as form_type, cik, cast(year as bigint) as year from a1
where {ANNUAL} and year in (1995, 1996)
  and o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')
"""
)
def select_filings(spark, sf_dir):
    builders = (
        a.table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == "BUILDING")
        .select(F.col("c_custkey").alias("cik"))
    )
    return d.select_filings(
        a.order_filings(spark, sf_dir), ciks=builders, years=[1996, "1995"]
    ).select("o_orderkey", "form_type", "cik", "year")


@query(
    """
select count(*) as n_rows,
  'input lacks required columns: [''amount'', ''currency'']' as complaint from a1
"""
)
def require_columns(spark, sf_dir):
    base = a.filings(spark, sf_dir)
    checked = d.require_columns(base, ["filename", "form_type", "cik", "year"])
    try:
        d.require_columns(base, ["currency", "cik", "amount"])
        complaint = ""
    except ValueError as error:
        complaint = str(error)
    return checked.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "complaint", F.lit(complaint)
    )


@query(
    """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, has_table,
  case when not has_table then null when annual1 and page1 then link1
    when annual2 and page2 then link2 when page1 then link1 when page2 then link2
    else link3 end as href
from a3
""",
    ctes=INDEX_PAGES_SQL,
)
def pick_document_a(spark, sf_dir):
    return d.pick_document(a.index_pages(spark, sf_dir), rule="A").drop("html")


@query(
    """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, has_table,
  case when not has_table then null when low1 then link1 when low2 then link2
    else link3 end as href
from a3
""",
    ctes=INDEX_PAGES_SQL,
)
def pick_document_b(spark, sf_dir):
    return d.pick_document(a.index_pages(spark, sf_dir), rule="B").drop("html")


# --- joins ------------------------------------------------------------------------


@query(f"select {FILING_COLUMNS} from a1 where o_orderstatus <> 'F'")
def pending_filings(spark, sf_dir):
    stored = a.order_filings(spark, sf_dir).filter(F.col("o_orderstatus") == "F")
    return d.pending(a.filings(spark, sf_dir), stored, ["sourcefile", "filename"])


_RESOLVED_SQL = """
select o_orderkey,
  case when status is not null then status when kind = 'direct' then '✅ Success (direct)'
    else '✅ Success (index)' end as status,
  case when o_orderstatus = 'P' then null
    when kind = 'direct' then concat('https://www.sec.gov/Archives/', filename)
    when linked then concat('https://www.sec.gov/Archives/edgar/data/', cik, '/', o_orderkey, '.htm')
    else concat('https://www.sec.gov/Archives/', filename, '/index.html') end as filing_url,
  status is null as ok,
  case when status is null then concat('<body>Order <b>', o_orderkey, '</b></body>') end as body
from (
  select *, case when o_orderstatus = 'P' then concat('⚠️ Invalid path: a/', o_orderkey)
      when o_totalprice > 480000 then '⚠️ Exception: no response landed'
      when o_totalprice < 50000 and kind = 'direct' then '❌ Filing fetch failed: 404'
      when o_totalprice < 50000 then '❌ Index fetch failed: 404'
      when kind = 'direct' then null
      when o_orderpriority = '5-LOW' then '⚠️ No document table found'
      when o_totalprice > 400000 then '❌ Filing fetch failed: 500' end as status,
    kind = 'index' and o_totalprice between 50000 and 480000 and o_orderpriority <> '5-LOW' as linked
  from (select *, case when filename like '%.txt' then 'direct' else 'index' end as kind from a1))
"""


@query(_RESOLVED_SQL)
def resolve_documents(spark, sf_dir):
    found = d.resolve_documents(a.asked_filings(spark, sf_dir), a.landed_responses(spark, sf_dir))
    return found.select("o_orderkey", "status", "filing_url", "ok", "body")


_RESOLVED_A_SQL = """
select o_orderkey,
  case when o_orderstatus = 'P' then null when o_totalprice > 480000 then '⚠️ Exception: no response landed'
    when o_totalprice < 50000 then '❌ Index fetch failed: 404'
    when o_orderpriority = '5-LOW' then '⚠️ No document table found'
    when o_totalprice > 400000 then '❌ Filing fetch failed: 500' else '✅ Success (index)' end as status,
  case when o_orderstatus <> 'P' and o_totalprice between 50000 and 480000 and o_orderpriority <> '5-LOW'
    then concat('https://www.sec.gov/Archives/edgar/data/', cik, '/', o_orderkey, '.htm') end as filing_url,
  o_orderstatus <> 'P' and o_totalprice between 50000 and 400000 and o_orderpriority <> '5-LOW' as ok,
  case when o_orderstatus <> 'P' and o_totalprice between 50000 and 400000 and o_orderpriority <> '5-LOW'
    then concat('<body>Order <b>', o_orderkey, '</b></body>') end as body
from a1
"""


@query(_RESOLVED_A_SQL)
def resolve_documents_a(spark, sf_dir):
    found = d.resolve_documents(
        a.asked_filings(spark, sf_dir), a.landed_responses(spark, sf_dir, rule="A"), rule="A", retry_limit=5
    )
    return found.select("o_orderkey", "status", "filing_url", "ok", "body")


@query(
    f"""
select count(*) as selected, count(distinct cik) as companies, count(*) filter (where ok) as ok,
  count(*) filter (where not ok) as fail, cast(0 as bigint) as skipped,
  array_to_string((select list(year order by year) from (select distinct cast(year as varchar) as year from a1 where {ANNUAL}
    order by year limit 10)), ' ') as years
from a1 join ({_RESOLVED_A_SQL}) using (o_orderkey) where {ANNUAL}
"""
)
def documents_run(spark, sf_dir):
    counts = d.documents_job(
        spark, a.asked_filings(spark, sf_dir), a.landed_responses(spark, sf_dir, rule="A"),
        work_path(spark, "store"), all=True,
    )
    row = {**counts, "years": " ".join(str(y) for y in counts["years"])}
    kinds = "selected bigint, companies bigint, ok bigint, fail bigint, skipped bigint, years string"
    return spark.createDataFrame([tuple(row[k.split()[0]] for k in kinds.split(", "))], kinds)


_FETCHED_SQL = f"""
select company_name, upper(form_type) as form_type, cik, date_filed, filename, year, quarter,
  sourcefile, line_no, case when ok then '✅ Success' else status end as status, filing_url, body as filing_text,
  case when ok then concat('Order', chr(10), o_orderkey) end as cleaned_text
from (select * from ({_RESOLVED_SQL}) join
  (select company_name, form_type, cik, date_filed, year, quarter, sourcefile, line_no,
    case when o_orderstatus = 'P' then concat('a/', o_orderkey) else filename end as filename,
    o_orderkey as k from a1) on k = o_orderkey)
where {ANNUAL}
"""


def _landed(spark, sf_dir):
    """Filings and responses as tables at rest, which is how a fetch run meets them."""
    asked = a.asked_filings(spark, sf_dir).drop(*a.EXTRA)
    tables = ((asked, "asked"), (a.landed_responses(spark, sf_dir), "responses"))
    return [spark.read.parquet(_staged(spark, df, label)) for df, label in tables]


@query(_FETCHED_SQL)
def fetch_run(spark, sf_dir):
    path = work_path(spark, "fetched")
    d.fetch_job(spark, *_landed(spark, sf_dir), path)
    return spark.read.parquet(path).drop("part")


@query(_FETCHED_SQL)
def stream_fetch(spark, sf_dir):
    """The same in micro-batches, each of which goes on numbering parts."""
    asked, responses = _landed(spark, sf_dir)
    source, target = _staged(spark, asked.repartition(3), "filings"), work_path(spark, "fetched")
    d.stream_fetch(spark, source, responses, target, work_path(spark, "progress"), files_per_batch=2)
    return spark.read.parquet(target).drop("part", "batch")


@query(_FETCHED_SQL)
def fetch_resume(spark, sf_dir):
    """A run over some listings, then one over all that leaves out what is there."""
    path = work_path(spark, "fetched")
    asked, responses = _landed(spark, sf_dir)
    for filings in (d.first_batches(asked, 9), asked, asked):
        d.fetch_job(spark, filings, responses, path, if_exists="append")
    return spark.read.parquet(path).drop("part")


# --- aggregations -----------------------------------------------------------------

_MONTHLY_SQL = f"""
select cast(month(order_date) as integer) as month,
  case month(order_date) when 9 then 'Sept' else strftime(order_date, '%b') end as month_name,
  count(*) as filings
from a1 where {ANNUAL} and dated group by 1, 2
"""


@query(_MONTHLY_SQL)
def monthly_counts(spark, sf_dir):
    """The whole first half of the pipeline: lines, filings, annual ones, months."""
    parsed = d.parse_index(a.index_lines(spark, sf_dir))
    return d.monthly_counts(d.filter_annual(parsed))


@query(_MONTHLY_SQL)
def monthly_counts_sorted(spark, sf_dir):
    return d.monthly_counts(d.filter_annual(a.filings(spark, sf_dir)), by="count")


def _describe_sql(column, source):
    return f"""
select '{column}' as column_name, cast(sum(n) as bigint) as "count", count(*) as "unique",
  arg_min(v, (-n, v)) as top, max(n) as freq
from (select {column} as v, count(*) as n from {source} where {column} is not null group by 1)
"""


@query(" union all ".join([_describe_sql("form_type", "a1"), _describe_sql("lang", "documents")]))
def describe_text(spark, sf_dir):
    forms = d.describe_text(a.filings(spark, sf_dir), "form_type")
    return forms.unionByName(d.describe_text(a.table(spark, sf_dir, "documents"), "lang"))


@query(
    """
select 'sourcefile' as column_name, count(distinct sourcefile) as distinct_values from a1
union all select 'cik', count(distinct cik) from a1
union all select 'form_type', count(distinct form_type) from a1
"""
)
def distinct_counts(spark, sf_dir):
    return d.count_distinct(a.filings(spark, sf_dir), "sourcefile", "cik", "form_type")


@query(
    """
select year, (select count(distinct year) from a1) > 5 as more
from (select distinct year from a1 order by year limit 5)
"""
)
def year_preview(spark, sf_dir):
    return d.year_preview(a.filings(spark, sf_dir), n=5)


@query(
    f"""
select count(*) as rows_in, count(*) filter (where {ANNUAL} and dated) as rows_out,
  count(*) filter (where {ANNUAL} and not dated) as undated, true as written,
  cast(ceil(count(*) filter (where {ANNUAL} and dated) / 500.0) as bigint) as parts from a1
"""
)
def run_summary(spark, sf_dir):
    # One file in, so that the parts follow from the rows alone.
    source = _staged(spark, a.filings(spark, sf_dir).repartition(1), "filings")
    counts = d.annual_job(spark, source, work_path(spark, "annual"), fmt="parquet", rows_per_part=500)
    return spark.createDataFrame([counts], "rows_in bigint, rows_out bigint, undated bigint, written boolean, parts bigint")


_ATTEMPT_SQL = """
, picked as (
  select filing_key, coalesce(min(attempt) filter (where status_code = 200 and body <> ''), max(attempt)) as attempt
  from a2 where attempt <= 2 group by filing_key),
resolved as (
  select a2.filing_key, a2.attempt, a2.status_code, case when a2.status_code = 200 then a2.body end as body,
    a2.status_code = 200 and a2.body <> '' as ok
  from a2 join picked on a2.filing_key = picked.filing_key and a2.attempt = picked.attempt)
"""


@query(
    """
select case when ok then '✅ Success' when status_code = 200 then '✅ Success (direct)'
    else concat('❌ Filing fetch failed: ', status_code) end as status, count(*) as records
from resolved group by 1
""",
    ctes=ATTEMPTS_SQL + _ATTEMPT_SQL,
)
def status_counts(spark, sf_dir):
    resolved = d.resolve_attempts(a.attempts(spark, sf_dir), ["filing_key"], retry_limit=2)
    return d.status_counts(d.outcome_records(a.attempt_outcomes(resolved)))


_PROFILE = (
    ("company_name", "string"), ("form_type", "string"), ("cik", "string"),
    ("date_filed", "date"), ("filename", "string"), ("year", "int"), ("quarter", "string"),
    ("sourcefile", "string"), ("line_no", "bigint"), ("month", "int"), ("month_name", "string"),
)


@query(
    " union all ".join(
        f"select '{name}' as column_name, '{dtype}' as dtype, "
        + ("count(*) filter (where dated)" if name in ("date_filed", "year", "month", "month_name") else "count(*)")
        + " as non_null from a1"
        for name, dtype in _PROFILE
    )
)
def profile_columns(spark, sf_dir):
    return d.profile(d.add_month_year(a.filings(spark, sf_dir)))


@query("select count(*) as n_rows, cast(5 as integer) as n_columns from documents", ctes=None)
def table_shape(spark, sf_dir):
    return d.shape(a.table(spark, sf_dir, "documents"))


@query(
    f"""
select sourcefile, count(*) as rows_in, count(*) filter (where {ANNUAL}) as rows_out from a1 group by sourcefile
"""
)
def batch_counts(spark, sf_dir):
    kept = d.normalize_form(F.col("form_type")).isin("10-K", "10-K/A")
    return d.batch_counts(a.filings(spark, sf_dir), kept)


# --- order ------------------------------------------------------------------------


@query(
    """
select event_id, cast(coalesce(sum(case when event_type <> 'error' then 1 else 0 end) over (
  order by event_id rows between unbounded preceding and 1 preceding), 0) as bigint) // 200 as part
from events
""",
    ctes=None,
)
def assign_part(spark, sf_dir):
    events = a.table(spark, sf_dir, "events").select("event_id", "event_type")
    ok = F.col("event_type") != "error"
    return d.assign_part(events, "event_id", ok, 200, range_rows=1024).select("event_id", "part")


@query(
    """
select sourcefile, line_no, cast(coalesce(sum(case when o_orderstatus = 'F' then 1 else 0 end) over (
  order by sourcefile, line_no rows between unbounded preceding and 1 preceding), 0) as bigint) // 50
  as part
from a1
"""
)
def assign_part_by_file(spark, sf_dir):
    numbered = d.assign_part(
        a.order_filings(spark, sf_dir).select("sourcefile", "line_no", "o_orderstatus"),
        "line_no", F.col("o_orderstatus") == "F", 50, group="sourcefile", range_rows=512,
    )
    return numbered.select("sourcefile", "line_no", "part")


@query(
    """
select event_id * 922337203685 - 4611686018427387000 as position,
  row_number() over (partition by event_type order by event_id) - 1 as row_index
from events
""",
    ctes=None,
)
def row_index_sparse(spark, sf_dir):
    position = F.col("event_id") * 922337203685 - 4611686018427387000
    events = a.table(spark, sf_dir, "events").select("event_type", position.alias("position"))
    return d.row_index(events, "event_type", "position").select("position", "row_index")


@query(
    "select filing_key, attempt, status_code, body, ok from resolved",
    ctes=ATTEMPTS_SQL + _ATTEMPT_SQL,
)
def resolve_attempts(spark, sf_dir):
    return d.resolve_attempts(a.attempts(spark, sf_dir), ["filing_key"], retry_limit=2)


@query(
    f"""
select sourcefile, line_no, row_number() over (partition by sourcefile order by line_no) - 1
  as row_index
from a1 where {ANNUAL}
"""
)
def row_index(spark, sf_dir):
    kept = d.keep_annual_forms(a.filings(spark, sf_dir))
    return d.row_index(kept).select("sourcefile", "line_no", "row_index")


@query(f"{_ANNUAL_SQL} order by sourcefile, line_no limit 10")
def first_n(spark, sf_dir):
    return d.first_n(d.filter_annual(a.filings(spark, sf_dir)), 10)


@query(
    f"""
select {FILING_COLUMNS} from a1
where sourcefile in (select distinct sourcefile from a1 order by sourcefile limit 3)
"""
)
def first_batches(spark, sf_dir):
    return d.first_batches(a.filings(spark, sf_dir), 3)


@query(
    f"""
select {FILING_COLUMNS} from a1
qualify row_number() over (partition by sourcefile order by line_no) = 11
"""
)
def nth_record(spark, sf_dir):
    return d.nth_record(a.filings(spark, sf_dir), 10)


@query(
    """
select company_name, form_type, cik, date_filed, filename, year,
  case when o_orderstatus <> 'F' then quarter end as quarter, sourcefile, line_no from a1
"""
)
def ordered_union(spark, sf_dir):
    base = a.order_filings(spark, sf_dir)
    finished = base.filter(F.col("o_orderstatus") == "F").drop(*a.EXTRA, "quarter")
    others = base.filter(F.col("o_orderstatus") != "F").drop(*a.EXTRA)
    return d.union_all([others, finished])


# --- outcomes ---------------------------------------------------------------------


@query(
    """
select filing_key, case when ok then '✅ Success' when status_code = 200 then '✅ Success (direct)'
    else concat('❌ Filing fetch failed: ', status_code) end as status,
  concat('https://www.sec.gov/Archives/', filing_key) as filing_url,
  case when ok then body end as filing_text,
  case when ok then regexp_extract(body, '<p>(.*)</p>', 1) end as cleaned_text
from resolved
""",
    ctes=ATTEMPTS_SQL + _ATTEMPT_SQL,
)
def outcome_records(spark, sf_dir):
    resolved = d.resolve_attempts(a.attempts(spark, sf_dir), ["filing_key"], retry_limit=2)
    return d.outcome_records(a.attempt_outcomes(resolved))


# --- streams ----------------------------------------------------------------------


@query(_ANNUAL_SQL)
def stream_filter(spark, sf_dir):
    source = _staged(spark, a.filings(spark, sf_dir), "filings")
    target = work_path(spark, "annual")
    d.stream_filter(spark, source, target, work_path(spark, "progress"), files_per_batch=4)
    return spark.read.parquet(target)


@query(_ANNUAL_SQL)
def stream_resume(spark, sf_dir):
    """Three runs: what is there, nothing new, and the rest once it has arrived."""
    base = a.order_filings(spark, sf_dir)
    source, target = work_path(spark, "filings"), work_path(spark, "annual")
    progress = work_path(spark, "progress")
    finished = F.col("o_orderstatus") == "F"
    base.filter(finished).drop(*a.EXTRA).write.parquet(source)
    d.stream_filter(spark, source, target, progress)
    d.stream_filter(spark, source, target, progress)
    base.filter(~finished).drop(*a.EXTRA).write.mode("append").parquet(source)
    d.stream_filter(spark, source, target, progress)
    return spark.read.parquet(target)


@query(_CLEAN_SQL, ctes=None)
def stream_clean(spark, sf_dir):
    target = work_path(spark, "cleaned")
    schema = a.table(spark, sf_dir, "pages").schema
    # A pattern finds the table as one file as well as a folder of files.
    d.stream_clean(spark, f"{sf_dir}/pages.parque[t]", target, work_path(spark, "progress"), schema)
    return spark.read.parquet(target).select("page_id", "cleaned_text")
