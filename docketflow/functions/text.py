"""Text helpers whose rules differ between Python and the JVM."""

from pyspark.sql import functions as F

from ..fixed import LINE_BREAK, WHITESPACE_CHARS



def strip(col):
    """Strip Unicode whitespace from both ends."""
    return F.btrim(col, F.lit(WHITESPACE_CHARS))


def split_lines(col):
    """Split text at every line break, not only at CR and LF."""
    return F.split(col, rf"\r\n|{LINE_BREAK}", -1)


def stripped_lines(col):
    """The lines of a text, stripped. Runs of line breaks count as one."""
    lines = F.split(col, f"{LINE_BREAK}+", -1)
    return F.transform(lines, lambda line: strip(line))


def remove_spaces(col):
    """Strip, then drop the spaces left inside."""
    return F.replace(strip(col), F.lit(" "), F.lit(""))


def snake_name(name):
    return name.replace(" ", "_").lower()
