"""Mapping of free-typed names to a reference list with a BK-tree under edit distance.

Distinct cleaned names are searched once each. The reference list, if it has at most `max_broadcast` entries, goes to every
task as one tree; a longer one is cut into shards, every block of names meets every shard, and the shards' winners are merged.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvarto.session import bounded_rows

#: what may follow or stand beside a name: dice, armour values, counts, bullets
_VALUES = re.compile(r"(?:,?\s*\bskada\b)?\s*\b\d+t\d+(?:[+-]\d+)?\b|,?\s*\babs\s*\d+|\(\s*bv\s*\d+\s*\)|\bbv\s*\d+|\bx\s*\d+\b|\b\d+\s+st\b")
_ENDINGS = ("arna", "erna", "orna", "ens", "ets", "en", "et", "er", "ar", "or", "n", "s", "t")
#: numbers that may be written as a figure at the start of a qualifier
_NUMERALS = {"en": "1", "två": "2", "tre": "3", "fyra": "4"}


def levenshtein(a: str, b: str) -> int:
    """Edit distance (insert, delete, substitute), bit-parallel over the first text."""
    if a == b:
        return 0
    if not a or not b:
        return len(a) + len(b)
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full, high = (1 << len(a)) - 1, 1 << len(a) - 1
    plus, minus, score = full, 0, len(a)
    for ch in b:
        eq = masks.get(ch, 0)
        d0 = (((eq & plus) + plus) ^ plus) | eq | minus
        hp = minus | ~(d0 | plus)
        hm = d0 & plus
        if hp & high:
            score += 1
        elif hm & high:
            score -= 1
        hp = (hp << 1 | 1) & full
        hm = hm << 1 & full
        plus = (hm | ~(d0 | hp)) & full
        minus = hp & d0
    return score


def damerau(a: str, b: str) -> int:
    """Edit distance in which swapping two neighbouring characters counts once, also around other edits (a metric)."""
    if a == b:
        return 0
    most = len(a) + len(b)
    seen: dict[str, int] = {}
    rows = [[most] * (len(b) + 2), [most, *range(len(b) + 1)]]
    for i, x in enumerate(a, 1):
        row, match = [most, i], 0
        for j, y in enumerate(b, 1):
            k, m = seen.get(y, 0), match
            same = x == y
            if same:
                match = j
            row.append(min(rows[i][j] + (not same), rows[i][j + 1] + 1, row[j] + 1, rows[k][m] + (i - k - 1) + 1 + (j - m - 1)))
        seen[x] = i
        rows.append(row)
    return rows[-1][-1]


class BKTree:
    """Entries by distance to their parent; a search visits only children that the triangle inequality allows."""

    def __init__(self, entries: Sequence[tuple[str, int]]):
        self.root: tuple | None = None
        for name, ident in entries:
            self.add(name, ident)

    def add(self, name: str, ident: int) -> None:
        if self.root is None:
            self.root = (name, [ident], {})
            return
        node = self.root
        while True:
            d = levenshtein(name, node[0])
            if d == 0:
                node[1].append(ident)
                return
            below = node[2].get(d)
            if below is None:
                node[2][d] = (name, [ident], {})
                return
            node = below

    def within(self, name: str, radius: int) -> list[tuple[int, str, list[int]]]:
        """(distance, entry, ids) of every entry at most `radius` away."""
        found, stack = [], [self.root] if self.root else []
        while stack:
            entry, ids, below = stack.pop()
            d = levenshtein(name, entry)
            if d <= radius:
                found.append((d, entry, ids))
            stack.extend(child for edge, child in below.items() if d - radius <= edge <= d + radius)
        return found


def fold(text: str) -> str:
    """Lower case without accents, full-width forms and invisible characters."""
    text = unicodedata.normalize("NFKD", text.lower())
    return "".join(" " if ch.isspace() else ch for ch in text if not unicodedata.combining(ch) and unicodedata.category(ch) != "Cf")


def _short_forms(qualifier: str) -> list[str]:
    forms = [fold(qualifier)]
    forms += [digit + fold(qualifier[len(word) :]) for word, digit in _NUMERALS.items() if qualifier.startswith(word)]
    return forms


def _abbreviates(token: str, form: str) -> bool:
    """Whether a token is the form itself or letters of it in order, from the first one."""
    if token == form:
        return True
    if not token or token[0] != form[0] or len(token) > min(4, len(form) - 1):
        return False
    rest = iter(form)
    return all(ch in rest for ch in token)


class NameMatcher:
    """Finds entries 'base' or 'base, qualifier' in a cleaned name: any word order, abbreviated qualifiers, words before the name."""

    def __init__(self, entries: Sequence[tuple[int, str]]):
        self.qualifiers: dict[str, list[str]] = {}
        keys = []
        for ident, name in entries:
            base, _, qualifier = name.partition(",")
            base, qualifier = re.sub(r"[^\w]", "", fold(base)), qualifier.strip().lower()
            if qualifier:
                self.qualifiers.setdefault(fold(qualifier), _short_forms(qualifier))
            keys.append((base + fold(qualifier), ident))
        self.tree = BKTree(sorted(keys))

    def candidates(self, name: str) -> Iterator[str]:
        """Spellings to look up: with and without leading words, qualifiers written out and put last, endings dropped."""
        tokens = [t for t in re.split(r"[\s,()/*;:]+", name) if t.strip(".-")]
        found = []
        for i, token in enumerate(tokens):
            bare = token.strip(".").replace("-", "")
            whole = [q for q, forms in self.qualifiers.items() if any(_abbreviates(bare, f) for f in forms)]
            if whole and len(tokens) > 1 and (token.endswith(".") or len(bare) <= 2 or any(f.startswith(bare) for q in whole for f in self.qualifiers[q])):
                found.append((i, whole))
        choices: list[tuple[list[str], str]] = [(tokens, "")]
        for i, whole in found:
            rest = tokens[:i] + tokens[i + 1 :]
            choices += [(rest, q) for q in whole]
        for rest, qualifier in choices:
            words = [re.sub(r"[^\w]", "", t) for t in rest]
            for skip in range(len(words)):
                base = "".join(words[skip:])
                if len(base) + len(qualifier) < 3:
                    continue
                yield base + qualifier
                for end in _ENDINGS:
                    if base.endswith(end) and len(base) - len(end) >= 4:
                        yield base[: -len(end)] + qualifier

    def best(self, name: str) -> tuple[int, list[int]] | None:
        """(distance, ids of the nearest entries) or None. Allowed: one edit for each four characters of the longer text, at most three."""
        best: tuple[int, list[int]] | None = None
        for text in dict.fromkeys(self.candidates(name)):
            limit = min(3, (len(text) + 2) // 4)
            if best:
                limit = min(limit, best[0])
            for _, entry, ids in self.tree.within(text, 2 * limit):
                d = damerau(text, entry)
                if d > min(limit, max(len(text), len(entry)) // 4):
                    continue
                if best is None or d < best[0]:
                    best = (d, list(ids))
                elif d == best[0]:
                    best = (d, sorted({*best[1], *ids}))
            if best and best[0] == 0:
                break
        return best


def clean_name(text: str | None) -> str:
    """The typed name: folded, without game values, counts and marks around it."""
    if text is None:
        return ""
    return re.sub(r"\s+", " ", _VALUES.sub(" ", fold(text))).strip(" .*,-–;:")


def _rows(matcher: NameMatcher, names) -> list[tuple]:
    out = []
    for name in names:
        hit = matcher.best(name) if name else None
        out.append((name, hit[0], hit[1]) if hit else (name, None, []))
    return out


def map_to_reference(df: DataFrame, name_col: str, reference: DataFrame, id_col: str, ref_name_col: str, max_broadcast: int = 20_000, shard_size: int = 20_000, block_size: int = 50_000) -> DataFrame:
    """`df` with item_id (nearest reference entry, -1 if none), distance and ambiguous.

    Cases: null and empty names are unmatched; names equally near to several entries are unmatched and ambiguous; repeated
    names are searched once; an empty reference leaves all unmatched; null reference names are skipped; of entries with the
    same name the lowest id counts. df keeps its columns; its own item_id, distance and ambiguous are replaced.
    """
    spark = df.sparkSession
    entries = reference.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{ref_name_col}`").alias("name")).filter("name IS NOT NULL AND id IS NOT NULL").groupBy("name").agg(F.min("id").alias("id"))
    cleaner = F.pandas_udf(lambda s: s.map(clean_name, na_action=None), "string")
    work = df.drop("item_id", "distance", "ambiguous").withColumn("clean__", cleaner(F.col(f"`{name_col}`")))
    names = work.select("clean__").distinct()
    schema = "clean__ string, distance int, ids array<long>"
    small = bounded_rows(entries, max_broadcast)
    if small is not None:
        shared = spark.sparkContext.broadcast(sorted((r["id"], r["name"]) for r in small))

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            matcher = NameMatcher(shared.value)
            for batch in batches:
                yield pd.DataFrame(_rows(matcher, batch["clean__"]), columns=["clean__", "distance", "ids"]).astype({"distance": "Int32"})

        # names are few bytes and each takes long: spread them over all cores whatever their size
        hits = names.repartition(2 * spark.sparkContext.defaultParallelism).mapInPandas(search, schema)
    else:
        shards = -(-entries.count() // shard_size)
        blocks = max(1, -(-names.count() // block_size))
        left = entries.withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        right = names.withColumn("block", F.pmod(F.xxhash64("clean__"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>")))

        def search_shard(entries: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
            matcher = NameMatcher(sorted(zip(entries["id"], entries["name"])))
            return pd.DataFrame(_rows(matcher, names["clean__"]), columns=["clean__", "distance", "ids"]).astype({"distance": "Int32"})

        hits = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(search_shard, schema)
        # the winner over all shards: the least distance, and all ids at it
        least = hits.groupBy("clean__").agg(F.min("distance").alias("distance"), F.collect_list(F.struct("distance", "ids")).alias("each"))
        hits = least.select("clean__", "distance", F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter("each", lambda x: x["distance"] == F.col("distance")), lambda x: x["ids"])))).alias("ids"))
    size = F.coalesce(F.size("ids"), F.lit(0))
    return work.join(hits, "clean__", "left").withColumns({"item_id": F.when(size == 1, F.col("ids")[0]).otherwise(F.lit(-1)).cast("int"), "ambiguous": size > 1}).drop("clean__", "ids")
