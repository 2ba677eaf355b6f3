"""Expressions that turn a filing's path into addresses and keys."""

from pyspark.sql import functions as F

from ..fixed import DOCUMENT_SUFFIX, INVALID_PATH, NO_FILENAME, SITE, VIEWER
from .text import remove_spaces, strip



def _path_text(col):
    return F.coalesce(remove_spaces(col), F.lit("None"))


def accession_parts(col):
    """Struct (cik, accession, index_url) from a path; nulls when it is too short."""
    parts = F.split(_path_text(col), "/", -1)
    cik = strip(F.get(parts, 2))
    accession = F.replace(strip(F.get(parts, 3)), F.lit(".txt"), F.lit(""))
    index_url = F.concat(
        F.lit(SITE + "/Archives/edgar/data/"), cik, F.lit("/"),
        F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"),
        accession, F.lit("-index.htm"),
    )
    return F.struct(
        cik.alias("cik"), accession.alias("accession"), index_url.alias("index_url")
    )


def fetch_target(col):
    """Struct (kind, url, status): where the filing's text is to be found.

    kind `direct`: the path names the document itself; `index`: the folder's index
    page must be consulted; `none`: the path is unusable and status says why.
    """
    path = _path_text(col)
    parts = F.split(path, "/", -1)
    direct = path.rlike(DOCUMENT_SUFFIX)
    usable = F.size(parts) >= 4
    kind = (
        F.when(path == "", "none").when(direct, "direct").when(usable, "index").otherwise("none")
    )
    url = F.when(
        direct, F.concat(F.lit(SITE + "/Archives/"), F.ltrim(path, F.lit("/")))
    ).when(
        usable,
        F.concat(
            F.lit(SITE + "/Archives/edgar/data/"), F.get(parts, 2), F.lit("/"),
            F.get(parts, 3), F.lit("/index.html"),
        ),
    )
    status = F.when(path == "", NO_FILENAME).when(
        ~direct & ~usable, F.concat(F.lit(INVALID_PATH), path)
    )
    return F.struct(kind.alias("kind"), url.alias("url"), status.alias("status"))


def absolute_url(col, rule="A"):
    """Link to full address. Rule A keeps absolute links, rule B prefixes always."""
    if rule == "B":
        return F.concat(F.lit(SITE + "/"), F.ltrim(col, F.lit("/")))
    link = strip(col)
    return (
        F.when(link.startswith("http://") | link.startswith("https://"), link)
        .when(link.startswith("/"), F.concat(F.lit(SITE), link))
        .otherwise(F.concat(F.lit(SITE + "/"), link))
    )


def fix_viewer_url(col):
    """Address of the raw document behind a viewer link."""
    return F.replace(col, F.lit(VIEWER), F.lit(SITE))


def storage_key(cik, year, filename):
    """Struct (cik, year, accession) naming where a document is stored."""
    accession = F.coalesce(
        F.nullif(accession_parts(filename)["accession"], F.lit("")), F.lit("unknown")
    )
    return F.struct(
        cik.alias("cik"),
        F.coalesce(year.cast("string"), F.lit("unknown")).alias("year"),
        F.replace(accession, F.lit("/"), F.lit("_")).alias("accession"),
    )
