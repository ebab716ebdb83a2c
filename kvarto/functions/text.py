"""Text expressions that stay in the JVM: keys, lenient parses, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ACCENTED = "åäàáâãÅÄÀÁÂÃöòóôõÖÒÓÔÕéèêëÉÈÊËüùúûÜÙÚÛíìîïÍÌÎÏçÇñÑýÿÝ"
PLAIN = "aaaaaaAAAAAAoooooOOOOOeeeeEEEEuuuuUUUUiiiiIIIIcCnNyyY"
#: list markers that aren't words
MARKERS = r"^(-+|•)$"


def normalise(text: Column) -> Column:
    """Lower case, accents of common Latin letters dropped, other non-ASCII characters removed, blanks collapsed."""
    plain = F.regexp_replace(F.translate(F.lower(text), ACCENTED, PLAIN), r"[^\x00-\x7F]", "")
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def name_key(text: Column) -> Column:
    """`normalise`, with every run of characters other than letters and digits as one blank."""
    return F.trim(F.regexp_replace(normalise(text), r"[^a-z0-9]+", " "))


def slug(text: Column) -> Column:
    """A file name: plain letters and digits joined by dashes, at most 80 characters, `bok` if nothing is left."""
    kept = F.regexp_replace(F.regexp_replace(normalise(text), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    cut = F.substring(kept, 1, 80)
    return F.when(cut == "", "bok").otherwise(cut)


def artifact_key(text: Column) -> Column:
    """Digits masked, lower case, the first 60 characters: equal for the running headers of all pages."""
    return F.substring(F.regexp_replace(F.lower(F.trim(text)), r"\d+", "#"), 1, 60)


def core(token: Column) -> Column:
    """A token without punctuation at its edges, in lower case; the token itself if nothing is left."""
    bare = F.regexp_replace(F.lower(token), r"^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$", "")
    return F.when(bare == "", F.lower(token)).otherwise(bare)


def tokens(text: Column) -> Column:
    """The words of a text without list markers."""
    return F.filter(F.split(F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " ")), " "), lambda t: (t != "") & ~t.rlike(MARKERS))


def as_int(text: Column) -> Column:
    """A whole number, perhaps with a percent sign; null for anything else."""
    return F.regexp_replace(F.trim(text), r"\s*%$", "").try_cast("int")


def leading_int(text: Column) -> Column:
    """The number a text begins with, unless a letter of a dice code follows it."""
    found = F.regexp_extract(text, r"^-?\d+(?![\dTtDd])", 0)
    return F.when(found != "", found).try_cast("int")


def without_leaders(text: Column) -> Column:
    """A heading without dot leaders, in capitals, without closing marks."""
    return F.regexp_replace(F.upper(F.trim(F.regexp_replace(text, r"\.{2,}.*$", ""))), r"[:.\s]+$", "")
