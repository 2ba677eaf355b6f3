"""From landed responses to one outcome record per filing."""

from pyspark.sql import functions as F

from ..fixed import (
    EXCEPTION,
    FETCH_FAILED,
    INDEX_FAILED,
    NO_LINK,
    NO_TABLE,
    SUCCESS,
    SUCCESS_DIRECT,
    SUCCESS_INDEX,
)
from ..functions.html import with_plain_text, with_primary_link
from ..functions.text import snake_name
from ..functions.urls import absolute_url, accession_parts, fetch_target
from ..session import staged

# Our own wording for a page nobody has landed.
NOT_LANDED = EXCEPTION + "no response landed"

_LAST = 1 << 40


def _rank(won):
    """Orders attempts: those that won first, by number, then the others, the last first."""
    attempt = F.col("attempt").cast("bigint")
    return F.when(won, attempt).otherwise(F.lit(_LAST) - attempt).alias("rank")


def _landed(responses, keys, retry_limit):
    """The attempts that count, written once with a number each; only an answer of 200 has a body.

    The pages that come with errors end here. A number is fixed by being written, so that an
    attempt can be chosen, and asked for, without its body.
    """
    answered = F.coalesce(F.col("status_code") == 200, F.lit(False))
    counted = F.coalesce(F.col("attempt").between(1, retry_limit), F.lit(False))
    body = F.when(answered & counted, F.col("body"))
    attempts = responses.select(*keys, "attempt", "status_code", counted.alias("counted"), body.alias("body"))
    return staged(
        attempts.withColumns({
            "has_body": F.coalesce(F.col("body") != "", F.lit(False)),
            "there": F.col("body").isNotNull(),
            # Of equal attempts the text that comes first counts, by its beginning and its hash.
            "begins": F.substring("body", 1, 32),
            "hash": F.xxhash64("body"),
            "place": F.monotonically_increasing_id(),
        }),
        "attempts",
    )


def _winners(landed, keys, wins):
    """One row per key, without its body: (keys, attempt, status_code, place, ok).

    This is an aggregate over narrow rows: attempts combine on the map side, so a key
    that holds a large share of all rows reaches its reducer as one row per task.
    """
    answered = F.coalesce(F.col("status_code") == 200, F.lit(False))
    won = F.col("has_body") if wins == "body" else answered
    columns = ["attempt", "status_code", "begins", "hash", "place", F.col("has_body").alias("ok"), "there"]
    outcome = F.struct(_rank(won), *columns)
    best = landed.groupBy(*keys).agg(F.min(F.when(F.col("counted"), outcome)).alias("best"))
    return best.select(
        *keys,
        "best.attempt",
        "best.status_code",
        F.when(F.col("best.there"), F.col("best.place")).alias("place"),
        F.coalesce("best.ok", F.lit(False)).alias("ok"),
    )


def with_bodies(df, landed):
    """Replace `place` by the body of that attempt; without a place there is none.

    Bodies pass one exchange and are never sorted: the narrow rows are what is hashed. Rows
    without a place get one of their own that no attempt has, and so spread over the tasks; Spark splits
    the rows of a place that very many share.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != "place"]
    place = F.coalesce(F.col("place"), -1 - F.monotonically_increasing_id())
    bodies = landed.filter(F.col("there")).select(F.col("place").alias("__place"), "body")
    rows = df.select(*others, place.alias("__asked")).hint("shuffle_hash")
    return rows.join(bodies, F.col("__asked") == F.col("__place"), "left").select(*others, "body")


def resolve_attempts(responses, keys=("url",), retry_limit=2, wins="body"):
    """One outcome per key: (keys, attempt, status_code, body, ok).

    Of the first `retry_limit` attempts the first answered 200 with a body wins
    (`wins="status"`: the first answered 200, whatever its body); failing all, the last
    one counts. Only an answer of 200 has a body. A key without an attempt in the limit keeps
    null outcome columns.

    Attempts are written once to the shared working folder and chosen without their bodies.
    """
    landed = _landed(responses, keys, retry_limit)
    found = with_bodies(_winners(landed, keys, wins), landed)
    return found.select(*keys, "attempt", "status_code", "body", "ok")


def pick_document(pages, html="html", rule="A"):
    """Add `href`, the main document's link, and `has_table` to index pages."""
    return with_primary_link(pages, html, rule)


def clean_pages(df, html="html", out="cleaned_text"):
    """Add the readable text of each page."""
    return with_plain_text(df, html, out)


def _index_links(landed, rule):
    """One row per landed index page: (url, index_code, has_table, link).

    Links are read from every attempt that counts, and the pages end here: only links
    are shuffled. Under rule B an attempt wins that gives a link, under rule A the first
    answered 200.
    """
    # Index addresses all end alike, which keeps document bodies out.
    ending = "/index.html" if rule == "B" else "-index.htm"
    answered = F.coalesce(F.col("status_code") == 200, F.lit(False))
    pages = landed.filter(F.col("url").endswith(ending)).select("url", "attempt", "status_code", "counted", "body")
    linked = with_primary_link(pages, "body", rule, "__href", "__has_table")
    linked = linked.withColumn("link", F.when(answered, absolute_url(F.col("__href"), rule)))
    outcome = F.struct(
        _rank(F.col("link").isNotNull() if rule == "B" else answered),
        F.col("status_code").alias("index_code"),
        F.col("__has_table").alias("has_table"),
        "link",
    )
    best = linked.groupBy("url").agg(F.min(F.when(F.col("counted"), outcome)).alias("best"))
    return best.select("url", "best.index_code", "best.has_table", "best.link")


def _landed_at(filings, address, landed, found):
    """Filings joined to what was landed at their `address`; `found` tells whether.

    `landed` is read from a written table and filings from their own shuffle, so that
    Spark splits an address that very many filings share, or that they all lack.
    """
    right = landed.withColumn(found, F.lit(True)).withColumnRenamed("url", "__url")
    joined = filings.join(right, F.col(address) == F.col("__url"), "left")
    return joined.withColumn(found, F.coalesce(found, F.lit(False))).drop("__url")


def match_documents(filings, responses, rule="B", retry_limit=2, filename="filename"):
    """Filings matched to landed pages, and those pages: two tables.

    The first has the filings with filing_url, ok, status and `place`, the number of the
    page in the second; `with_bodies` brings them together. Rule B: a path naming a document is looked
    up directly, a folder by way of its index page. Rule A: always by way of the filing's
    own index page.

    Attempts, links and documents are written to the shared working folder; only the first hold
    bodies.
    """
    if rule == "B":
        target = filings.withColumn("__target", fetch_target(F.col(filename)))
        direct = F.when(F.col("__target.kind") == "direct", F.col("__target.url"))
        index = F.when(F.col("__target.kind") == "index", F.col("__target.url"))
    else:
        target = filings.withColumn("__target", accession_parts(F.col(filename)))
        direct, index = F.lit(None).cast("string"), F.col("__target.index_url")
    target = target.withColumn("__direct", direct).withColumn("__index", index)

    landed = _landed(responses, ["url"], retry_limit)
    links = staged(_index_links(landed, rule), "links").toDF(
        "url", "__index_code", "__has_table", "__link"
    )
    documents = _winners(landed, ["url"], "body" if rule == "B" else "status")
    documents = staged(documents.select("url", "status_code", "place", "ok"), "documents").toDF(
        "url", "__code", "__place", "__ok"
    )
    linked = _landed_at(target, "__index", links, "__index_found")
    linked = linked.withColumn("__doc", F.coalesce("__direct", "__link"))
    found = _landed_at(linked, "__doc", documents, "__found")

    ok = F.coalesce(F.col("__ok"), F.lit(False))
    address = F.coalesce("__doc", "__index") if rule == "B" else F.col("__doc")
    result = found.withColumns({"status": _status(rule), "ok": ok, "filing_url": address})
    place = F.when(F.col("ok"), F.col("__place")).alias("place")
    return result.select(*filings.columns, "filing_url", place, "ok", "status"), landed


def resolve_documents(filings, responses, rule="B", retry_limit=2, filename="filename"):
    """Match filings to landed pages: adds filing_url, body, ok and status (see `match_documents`)."""
    matched, landed = match_documents(filings, responses, rule, retry_limit, filename)
    found = with_bodies(matched, landed)
    return found.select(*filings.columns, "filing_url", "body", "ok", "status")


def _status(rule):
    code, index_code = F.col("__code").cast("string"), F.col("__index_code").cast("string")
    bad_path = F.col("__target.status") if rule == "B" else F.lit(None).cast("string")
    return (
        F.when(F.col("__direct").isNull() & F.col("__index").isNull(), bad_path)
        .when(F.col("__index").isNotNull() & ~F.col("__index_found"), F.lit(NOT_LANDED))
        .when(F.col("__index_code") != 200, F.concat(F.lit(INDEX_FAILED), index_code))
        .when(F.col("__index").isNotNull() & ~F.coalesce("__has_table", F.lit(False)), F.lit(NO_TABLE))
        .when(F.col("__doc").isNull(), F.lit(NO_LINK))
        .when(~F.col("__found"), F.lit(NOT_LANDED))
        .when(F.col("__code") != 200, F.concat(F.lit(FETCH_FAILED), code))
        .when(F.col("__direct").isNotNull(), F.lit(SUCCESS_DIRECT))
        .otherwise(F.lit(SUCCESS_INDEX))
    )


def outcome_records(df):
    """Success and failure records in one table of equal columns.

    Expects filing_url, body, ok and status beside the filing's own columns, which are
    kept with snake_case names. Only successes carry text.
    """
    ok = F.coalesce(F.col("ok"), F.lit(False))
    own = [c for c in df.columns if c not in ("filing_url", "body", "ok", "status")]
    return clean_pages(
        df.select(
            F.when(ok, F.lit(SUCCESS)).otherwise(F.col("status")).alias("status"),
            F.col("filing_url"),
            F.when(ok, F.col("body")).alias("filing_text"),
            *[F.col(f"`{c}`").alias(snake_name(c)) for c in own],
        ),
        "filing_text",
        "cleaned_text",
    ).select(
        "status", "filing_url", "filing_text", "cleaned_text", *[snake_name(c) for c in own]
    )


def snake_columns(df):
    """All column names in snake_case."""
    return df.toDF(*[snake_name(c) for c in df.columns])
