"""Repair of text taken from scanned pages: running headers, page numbers, broken words, misrecognised characters.

What a text needs is first learnt from the whole corpus, as tables that are computed by joins and aggregates:

- headers: lines that recur at page edges (artifacts, titles, headings, edge lines of texts), exactly or within a few edits;
- offsets: by how much a book's printed page numbers differ from its pages, from the sequence of its lone numbers;
- pairs: for each word broken at a line end, whether the mark belongs to it, from the counts of both forms;
- tokens: for each written form, the word it is a misreading of, if undoing one or two confusions gives a far more frequent
  word or one that the lexicon composes. The confusions are learnt from correction records.

Then each text is repaired by looking its lines, pairs and tokens up in them: from a broadcast table where what was found is
small, else from tables joined to blocks of texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection, Iterable, Iterator, Mapping
from functools import lru_cache, partial

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvarto.llm.lookalike import Rewriter, kind_of, look_alikes, representatives
from kvarto.session import bounded_rows, checkpointed

#: fixed values: letters read for figures in dice codes
DICE_FIGURES = {"Z": "2", "z": "2", "A": "4", "S": "5", "G": "6", "b": "6", "B": "8", "O": "0", "o": "0", "Q": "0", "D": "0", "l": "1", "I": "1", "i": "1", "|": "1", "!": "1"}
DICE_SIDES = {"2", "3", "4", "6", "8", "10", "12", "20", "30", "100"}
#: chunks of text that a Python worker remembers at a time
KEPT_CHUNKS = 200_000
#: a longer run of letters is no word
MAX_WORD = 100
_TOKEN = re.compile(r"[\w|§!$]*[^\W\d_][\w|§!$]*(?:-[^\W\d_][\w|§!$]*)*")
_VOWEL = re.compile("[aeiouyåäöé]")
_ODD_SIGN = re.compile(r"[\d|§!$]")
_DICE = re.compile(r"(?<![\w|!])([\dA-Za-z|!]{1,2})T([\dA-Za-z|!]{1,3})([+-][\dA-Za-z|!]{1,2})?(?![\w|])")
_NUMBER = r"(?:[-–—•~*|\[(<·.]\s*)*(?:(?:sida|sidan|sid\.|s\.|p\.|page)\s*)?(\d{1,4}|[ivxlc]+)\s*(?:[-–—•~*|\])>·.]\s*)*"
_ONLY_NUMBER = re.compile(_NUMBER, re.I)
_NUMBER_FIRST = re.compile(_NUMBER + r"(?<=\s)\s+(?=\S)(.*)", re.I)
_NUMBER_LAST = re.compile(r"(.*\S)\s{2,}" + _NUMBER, re.I)
#: what every line that begins with a number begins with, quick to look for
_MAY_BEGIN = re.compile(r"[\W_]*(?:(?:sida|sidan|sid|s|p|page)\b[\W_]*)?(?:\d|[ivxlc]+(?![^\W\d_]))", re.I)
_DASH = re.compile(r"\s[–—|~•/-]\s+")
_LETTER = re.compile(r"[^\W\d_]")
_CHAPTER = re.compile(r"^(?:kapitel|kap\.?|del|avsnitt)\s*(?:\d+|[ivxlc]+)\s*[:.–-]\s*", re.I)
_MARKS = "-¬–‐‑\u00ad"
_LEFT_PART = re.compile(rf"([^\W_]+)([{_MARKS}])$")
_LEFT_TOKEN = re.compile(r"[\w|§!$-]*$")
_RIGHT_TOKEN = re.compile(r"[\w|§!$-]*")
_FIRST_WORD = re.compile(r"[^\W\d_]+")
#: all characters that the look-alike rules may touch
_OTHER_FORMS = re.compile("[\u00a0\u00ad\u0250-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufe00-\uffff]")
_HEADER_END = re.compile(r"[.!?…,;][\"”']?\s*$")
_SENTENCE_END = re.compile(r"[.!?…:][\"”'’)]*\s*$")
_SEPARATE = ("och", "eller", "samt", "respektive")
_LINE = re.compile(r"\r\n|\r|\n")


def roman(n: int) -> str:
    out = ""
    for value, sign in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out, n = out + sign * (n // value), n % value
    return out


def is_page(number: str, page: int | None, offsets: Collection[int] = ()) -> bool:
    """Whether a printed number is that of the page, or follows it by one of the book's offsets; any number may be, where the page is unknown."""
    if page is None:
        return number.isdigit()
    return any(int(number) == p if number.isdigit() else p > 0 and number.lower() == roman(p) for p in (page, *(page + o for o in offsets)))


def header_key(line: str) -> str:
    """A line's letters and digits alone, in lower case, without a chapter number."""
    return re.sub(r"[\W_]+", "", _CHAPTER.sub("", line.strip(" ~*•|-–—[]")).lower())


def header_parts(line: str) -> list[str]:
    """Keys of a line and of the titles it joins by a dash, without a page number beside them."""
    line = line.strip()
    for number, rest in page_options(line):
        if rest:
            line = rest
            break
    pieces = [line, *_DASH.split(line)] if _DASH.search(line) else [line]
    return [k for k in dict.fromkeys(map(header_key, pieces)) if len(k) >= 3 and not k.isdigit()]


def page_options(line: str) -> list[tuple[str, str]]:
    """The ways to read a line as a page number and what stands beside it."""
    out = []
    if _MAY_BEGIN.match(line):
        m = _ONLY_NUMBER.fullmatch(line)
        if m:
            return [(m[1], "")]
        m = _NUMBER_FIRST.fullmatch(line)
        if m:
            out.append((m[1], m[2]))
    if "  " in line or "\t" in line:
        m = _NUMBER_LAST.fullmatch(line)
        if m:
            out.append((m[2], m[1]))
    return out


def has_other_forms(text: str) -> bool:
    """Whether the look-alike rules may touch a text; plain Latin-1 texts are told apart without a search."""
    try:
        text.encode("latin-1")
        return "\u00a0" in text or "\u00ad" in text
    except UnicodeEncodeError:
        return _OTHER_FORMS.search(text) is not None


def plain(text: str) -> str:
    return plain_forms()(text)[0] if has_other_forms(text) else text


def may_be_header(line: str, beside_number: bool) -> bool:
    """A line without a sentence's end that opens with a capital, or stands beside a page number."""
    if len(line) < 3 or line[0].islower() and not beside_number or line[-1] in ".,;":
        return False
    opening = _LETTER.search(line)
    return opening is not None and (opening[0].isupper() or beside_number) and not _HEADER_END.search(line)


def looks_printed(line: str) -> bool:
    """Set as headers are: between swung dashes, in capitals, or with a chapter's number."""
    return re.fullmatch(r"~\s+\S.*\S\s+~", line) is not None or line.isupper() and sum(map(str.isalpha, line)) > 4 and line[-1] not in "-¬" or _CHAPTER.match(line) is not None


#: shorter lines recur exactly: one edit makes `ingen` of the heading `Ringen`
LEAST_NEAR = 6


def edits(size: int) -> int:
    """How many characters a recurring header may differ in: an eighth of its length, one at least and eight at most; none if it is short."""
    return min(8, max(1, size // 8)) if size >= LEAST_NEAR else 0


@lru_cache(maxsize=None)
def cuts(size: int, d: int) -> list[tuple[int, int]]:
    return [(i * size // (d + 1), (i + 1) * size // (d + 1)) for i in range(d + 1)]


def stored_pieces(key: str) -> Iterator[str]:
    """Pieces under which a key is found by every line within that line's edits."""
    n = len(key)
    for d in {edits(m) for m in range(max(LEAST_NEAR, n - 8), n + 9) if abs(m - n) <= edits(m)}:
        for i, (a, b) in enumerate(cuts(n, d)):
            yield f"{n} {d} {i} {key[a:b]}"


def sought_pieces(line: str, sizes: Collection[int]) -> Iterator[str]:
    """Of a key's d + 1 pieces one stands unchanged in a line within d edits: piece i at most i places off counted from the left, and d - i from the right.

    `sizes` are the lengths of the keys there are.
    """
    m = len(line)
    d = edits(m)
    for n in range(m - d, m + d + 1):
        if n not in sizes:
            continue
        for i, (a, b) in enumerate(cuts(n, d)):
            for shift in range(max(-i, m - n - (d - i), -a), min(i, m - n + d - i) + 1):
                piece = line[a + shift : b + shift]
                if len(piece) == b - a:
                    yield f"{n} {d} {i} {piece}"


class Confusions:
    """Pairs (printed, read): what was printed and what recognition made of it."""

    def __init__(self, pairs: Iterable[tuple[str, str]]):
        self.printed: dict[str, list[str]] = {}
        self.read: dict[str, list[str]] = {}
        for right, wrong in pairs:
            self.printed.setdefault(wrong, []).append(right)
            self.read.setdefault(right, []).append(wrong)

    def undone(self, word: str) -> set[str]:
        """The words of which this one is a misreading by one confusion, at one place or at all its places."""
        return _replaced(word, self.printed)

    def made(self, word: str) -> set[str]:
        """The misreadings of a word by one confusion."""
        return _replaced(word, self.read)


def _replaced(word: str, table: Mapping[str, list[str]]) -> set[str]:
    out = set()
    for old, news in table.items():
        at = word.find(old)
        if at < 0:
            continue
        many = word.count(old) > 1
        for new in news:
            if many:
                out.add(word.replace(old, new))
            i = at
            while i >= 0:
                out.add(word[:i] + new + word[i + len(old) :])
                i = word.find(old, i + 1)
    out.discard(word)
    return out


def differing(original: str, corrected: str) -> Iterator[tuple[str, str]]:
    """(printed, read) of each word in which two readings of a text differ in one place of one or two characters."""
    a, b = original.lower().split(), corrected.lower().split()
    if len(a) != len(b):
        return
    for wrong, right in zip(a, b):
        if wrong != right:
            i = 0
            while i < min(len(wrong), len(right)) and wrong[i] == right[i]:
                i += 1
            j = 0
            while j < min(len(wrong), len(right)) - i and wrong[-1 - j] == right[-1 - j]:
                j += 1
            w, r = wrong[i : len(wrong) - j], right[i : len(right) - j]
            if 0 < len(w) <= 2 and 0 < len(r) <= 2:
                yield r, w


def learn_confusions(corrections: DataFrame, original: str = "original", corrected: str = "corrected", least: int = 2, share: float = 1 / 2000) -> list[tuple[str, str]]:
    """The confusions that correction records show at least `least` times and as `share` of all (so at most 1 / share of them)."""

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Counter(p for o, c in zip(batch["o"], batch["c"]) for p in differing(plain(o), plain(c)))
            yield pd.DataFrame([(*p, n) for p, n in found.items()], columns=["printed", "read", "n"])

    both = corrections.select(F.col(f"`{original}`").alias("o"), F.col(f"`{corrected}`").alias("c")).filter("o IS NOT NULL AND c IS NOT NULL AND o <> c").distinct()
    pairs = checkpointed(both.mapInPandas(align, "printed string, read string, n long").groupBy("printed", "read").agg(F.sum("n").alias("n")))
    total = pairs.agg(F.sum("n")).first()[0] or 0
    rows = pairs.filter(F.col("n") >= max(least, total * share)).orderBy(F.desc("n"), "printed", "read").collect()
    return [(r["printed"], r["read"]) for r in rows]


class Lexicon:
    """Word forms and first parts of compounds."""

    def __init__(self, words: Collection[str], prefixes: Collection[str]):
        self.words, self.prefixes = words, prefixes
        self.longest = max(map(len, prefixes), default=0)

    def composes(self, word: str) -> bool:
        """A lexicon word, or a lexicon word after a known first part."""
        return word in self.words or any(word[:i] in self.prefixes and word[i:] in self.words for i in range(2, min(self.longest, len(word) - 2) + 1))


def odd_capitals(token: str) -> str | None:
    """What a token with a capital I or U inside says, if that capital is a misread small letter."""
    if "-" in token or not any(ch in "IU" for ch in token[1:]) or not any(ch.islower() for ch in token):
        return None
    word = (token[0] + token[1:].replace("I", "l").replace("U", "ll")).lower()
    return word if word != token.lower() else None


def forms_of_token(token: str) -> Iterator[tuple[str, str]]:
    """(role, word) of the words that decide what a token says; parts of a word with hyphens are judged one by one."""
    for role, form in (("w", token), ("b", token.rstrip("!"))):
        word = form.lower()
        if role == "b" and form == token:
            continue
        yield role, word
        if "-" in word:
            yield from ((f"{role}{i}", part) for i, part in enumerate(word.split("-")))
    inside = odd_capitals(token)
    if inside:
        yield "i", inside
    inside = odd_capitals(token.rstrip("!")) if token[-1:] == "!" else None
    if inside:
        yield "j", inside


def judged_token(token: str, found: Mapping[str, tuple[str, bool, str | None]]) -> tuple[int, str] | None:
    """(how many characters are misread, what they say) from role -> (word, whether it is known, its reading), or None."""
    role, inside = "w", "i"
    if "b" in found and found["b"][1]:
        token, role, inside = token.rstrip("!"), "b", "j"
    word = token.lower()
    if "-" in word:
        parts = word.split("-")
        readings = [found.get(f"{role}{i}", ("", False, None))[2] for i in range(len(parts))]
        reading = "-".join(r or p for r, p in zip(readings, parts)) if any(readings) else None
    else:
        reading = found.get(role, ("", False, None))[2]
    if reading is None and inside in found:
        word, known, again = found[inside]
        reading = word if known else again
    return (len(token), _cased(token, reading)) if reading else None


def _cased(word: str, reading: str) -> str:
    """The reading with the capitals of the word it replaces."""
    parts, new = word.split("-"), reading.split("-")
    if len(parts) != len(new):
        return reading
    out = []
    for old, text in zip(parts, new):
        if old.lower() == text:
            text = old
        elif len(old) > 1 and old.isupper():
            text = text.upper()
        elif old[:1].isupper() and (text[:1] == old[:1].lower() or old[:1] not in "IU"):
            text = text[:1].upper() + text[1:]
        out.append(text)
    return "-".join(out)


@lru_cache(maxsize=1)
def plain_forms() -> Rewriter:
    """Rewriting of look-alike forms where no corpus has been counted: to plain and Latin ones."""
    always, letters = look_alikes()
    return Rewriter(representatives(always, {}), _latin(letters))


def _latin(classes) -> dict[str, str]:
    out = {}
    for members in classes.members().values():
        latin = sorted(x for x in members if len(x) == 1 and kind_of(x) == "latin")
        out.update((x, latin[0]) for x in members if latin and len(x) == 1 and kind_of(x) == "other")
    return out


#: how many lines that may be headers or page numbers a page break can hold within a word
BREAK_LINES = 6


def observe(text: str, book: str | None, page: int | None, chunks: Counter, others: dict) -> None:
    """What must be known to repair a text: its chunks between blanks, words broken at line ends, lines that may be headers, lone numbers."""
    lines = [x for x in map(str.strip, _LINE.split(plain(text))) if x]
    if len(lines) == 1:
        chunks.update(lines[0].split())
        return
    options = [page_options(x) for x in lines]
    lone = [bool(o) and not o[0][1] for o in options]
    removable = []
    for i, (line, opts) in enumerate(zip(lines, options)):
        keys: list[str] = []
        if lone[i]:
            if page is not None and opts[0][0].isdigit():
                others["number", book, str(int(opts[0][0]) - page), page] = 1
        else:
            if may_be_header(line, bool(opts)):
                keys = header_parts(line)
            edge = i == 0 or i == len(lines) - 1 or lone[i - 1] or lone[i + 1]
            others.update((("line", book, k, page if edge else None), 1) for k in keys)
        removable.append(lone[i] or bool(keys))
    cut = False
    for i, line in enumerate(lines):
        found = line.split()
        if cut:
            del found[0]
        m = line[-1] in _MARKS and _LEFT_PART.search(line[-MAX_WORD:])
        cut = False
        if m and m[1][-1].isalpha():
            cut = i + 1 < len(lines) and lines[i + 1][0].isalpha()
            if cut:
                del found[-1:]
            for j in range(i + 1, min(i + 2 + BREAK_LINES, len(lines))):
                first = _FIRST_WORD.match(lines[j])
                if first:
                    others["pair", None, f"{m[1]} {m[2]} {first[0]}", None] = 1
                    left, right = _LEFT_TOKEN.search(line[:-1][-MAX_WORD:])[0], _RIGHT_TOKEN.match(lines[j])[0]
                    for joined in (left + right, left + m[2] + right):
                        others.update((("token", None, t, None), 0) for t in _TOKEN.findall(joined))
                if not removable[j]:
                    break
        chunks.update(found)


def tokens_of(chunks: Mapping[str, int]) -> Counter:
    """The tokens in distinct chunks, with their number."""
    out: Counter[str] = Counter()
    for chunk, n in chunks.items():
        for token in _TOKEN.findall(chunk):
            out[token] += n
    return out


_OBSERVED = "kind string, book string, key string, page int, n long"


def observed(texts: DataFrame, flush: int = 200_000) -> DataFrame:
    """(kind, book, key, page, n) of all that `observe` sees in texts (book, page, text), each once; tokens with their number."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunks: Counter[str] = Counter()
        others: dict[tuple, int] = {}
        for batch in batches:
            pages = batch["page"].astype("object").where(batch["page"].notna(), None)
            books = batch["book"].astype("object").where(batch["book"].notna(), None)
            for book, page, text in zip(books, pages, batch["text"]):
                if text and not text.isspace():
                    observe(text, book, None if page is None else int(page), chunks, others)
            if len(chunks) + len(others) > flush:
                yield _observed_frame(chunks, others)
                chunks, others = Counter(), {}
        yield _observed_frame(chunks, others)

    return texts.select("book", F.col("page").cast("int").alias("page"), "text").filter("text IS NOT NULL").mapInPandas(look, _OBSERVED).groupBy("kind", "book", "key", "page").agg(F.sum("n").alias("n"))


def _observed_frame(chunks: Counter, others: dict) -> pd.DataFrame:
    rows = [("token", None, t, None, n) for t, n in tokens_of(chunks).items()] + [(*k, n) for k, n in others.items()]
    return pd.DataFrame(rows, columns=["kind", "book", "key", "page", "n"]).astype({"page": "Int32"})


def word_counts(seen: DataFrame) -> DataFrame:
    """(word, n, small): occurrences of every word in lower case, and of those that begin with a small letter."""
    form = F.regexp_replace("key", "!+$", "")
    words = seen.filter("kind = 'token' AND n > 0").select(form.alias("form"), "n").filter(F.col("form").rlike(r"^\p{L}+(-\p{L}+)*$"))
    small = F.when(F.substring("form", 1, 1) == F.lower(F.substring("form", 1, 1)), F.col("n")).otherwise(0)
    return words.groupBy(F.lower("form").alias("word")).agg(F.sum("n").alias("n"), F.sum(small).alias("small"))


@lru_cache(maxsize=100_000)
def _bits(ch: str, n: int) -> int:
    out = 0
    for i in range(n):
        out |= 1 << ((ord(ch) * 0x9E3779B1 + i * 0x85EBCA6B) >> 16 & 127)
    return out


def bag_bits(key: str) -> int:
    """128 bits of the characters of a key, the second of a kind apart from the first and so on: an edit changes two of them at most."""
    out = 0
    for ch in set(key):
        out |= _bits(ch, key.count(ch))
    return out


def _bags(keys: Column) -> Column:
    @F.pandas_udf("struct<low: long, high: long>")
    def bags(batch: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([((b & (1 << 64) - 1) - (1 << 63), (b >> 64) - (1 << 63)) for b in map(bag_bits, batch)], columns=["low", "high"], dtype="int64")

    return bags(keys)


def header_table(seen: DataFrame, lines: DataFrame, crowd: int = 4_096) -> DataFrame:
    """(book, key, value) of text lines that recur: `seed` if a page edge, title or heading (`lines`: book, text) says the same within a few edits, `repeat` if only edge lines of texts on other pages do.

    Of a book, each line is compared with all others of about its length by the bags of their characters, and by edits where
    these are alike. Where there are more than `crowd` others, only those that share a piece with it are compared, which finds the same.
    """

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(b, k) for b, text in zip(batch["book"], batch["text"]) for k in header_parts(plain(text))]
            yield pd.DataFrame(rows, columns=["book", "key"]).drop_duplicates().astype("string")

    def pieces(f, sized: bool = False):
        """(line, size, low, high, piece), lines and pieces as hashes of 8 bytes: rows are many, and what is found is looked at again."""

        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                more = ((set(x),) for x in batch["sizes"]) if sized else ((),) * len(batch)
                same = zip(batch["line"], batch["size"], batch["low"], batch["high"])
                rows = [(*x, xxhash.xxh3_64_intdigest(f"{b} {p}") - (1 << 63)) for x, b, k, m in zip(same, batch["book"], batch["key"], more) for p in dict.fromkeys(f(k, *m))]
                yield pd.DataFrame(rows, columns=[*compared, "piece"], dtype="int64")

        return lambda df: df.select(*compared, "book", "key", *["sizes"] * sized).mapInPandas(cut, "line long, size long, low long, high long, piece long")

    compared = ["line", "size", "low", "high"]
    other = lambda df: df.withColumnsRenamed({c: f"other_{c}" for c in compared})
    seeds = lines.filter("book IS NOT NULL AND text IS NOT NULL").select("book", "text").distinct().mapInPandas(keys, "book string, key string").distinct()
    own = seen.filter("kind = 'line' AND book IS NOT NULL").groupBy("book", "key").agg(F.min("page").alias("first"), F.max("page").alias("last"))
    table = own.withColumn("said", F.lit(True)).join(seeds.withColumn("seed", F.lit(True)), ["book", "key"], "full").fillna(False, ["said", "seed"])
    table = table.withColumns({"line": F.xxhash64("book", "key"), "size": F.length("key").cast("long"), "bag": _bags("key")})
    table = checkpointed(table.select("book", "key", "first", "last", "said", "seed", "line", "size", "bag.low", "bag.high"))
    asking, asked = table.filter(f"said AND NOT seed AND size >= {LEAST_NEAR}"), table.filter("seed OR first IS NOT NULL")
    # lines meet in blocks of a book's lines of 16 lengths: one or two hold all that are within a line's edits
    within = "least(8, greatest(1, size div 8))"
    asks = asking.withColumn("block", F.explode(F.expr(f"transform(sequence((size - {within}) div 16, (size + {within}) div 16), b -> xxhash64(book, b))")))
    blocks = asked.withColumn("block", F.expr("xxhash64(book, size div 16)"))
    alike = F.expr(f"line <> other_line AND abs(size - other_size) <= {within} AND bit_count(low ^ other_low) + bit_count(high ^ other_high) <= 2 * {within}")
    crowded = checkpointed(blocks.groupBy("block").agg(F.count("*").alias("n"), F.collect_set("size").alias("sizes")).filter(F.col("n") > crowd).select("block", "sizes"))
    some = not crowded.isEmpty()
    few = blocks.join(crowded, "block", "left_anti") if some else blocks
    met = asks.select("block", *compared).join(other(few.select("block", *compared)), "block").filter(alike).select("line", "other_line")
    if some:
        sought, stored = pieces(sought_pieces, True)(asks.join(crowded, "block")), pieces(stored_pieces)(blocks.join(crowded, "block"))
        met = met.unionByName(sought.join(other(stored), "piece").filter(alike).select("line", "other_line").distinct())
    found = asked.select(F.col("line").alias("other_line"), F.col("book").alias("other_book"), F.col("key").alias("other"), F.col("first").alias("other_first"), F.col("last").alias("other_last"), F.col("seed").alias("other_seed"))
    near = met.join(asking, "line").join(found, "other_line").filter((F.col("book") == F.col("other_book")) & (F.levenshtein("key", "other", 8).between(0, F.expr(within))))
    near = near.select("book", "key", F.least("first", "other_first").alias("first"), F.greatest("last", "other_last").alias("last"), F.col("other_seed").alias("seed"))
    exact = table.filter("said AND (seed OR first <> last)").select("book", "key", "first", "last", "seed")
    every = exact.unionByName(near).groupBy("book", "key").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.max("seed").alias("seed"))
    return every.filter("seed OR first <> last").select("book", "key", F.when(F.col("seed"), "seed").otherwise("repeat").alias("value"))


def offset_table(seen: DataFrame, artifacts: DataFrame, least: int = 3) -> DataFrame:
    """(book, key, value) of the offsets (printed number less page) that most of a book's lone numbers follow, on `least` pages or more; 0 needs none."""

    def numbers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(b, str(int(o[0][0]) - int(p)), p) for b, p, t in zip(batch["book"], batch["page"], batch["text"]) if (o := page_options(plain(t).strip())) and not o[0][1] and o[0][0].isdigit()]
            yield pd.DataFrame(rows, columns=["book", "key", "page"])

    edge = artifacts.filter("book IS NOT NULL AND page IS NOT NULL AND text IS NOT NULL").select("book", F.col("page").cast("int").alias("page"), "text").mapInPandas(numbers, "book string, key string, page int")
    each = seen.filter("kind = 'number' AND book IS NOT NULL").select("book", "key", "page").unionByName(edge).groupBy("book", "key").agg(F.count_distinct("page").alias("pages"))
    best = each.groupBy("book").agg(F.sum("pages").alias("all"), F.max(F.struct("pages", "key")).alias("best"))
    return best.filter(F.col("best.key") != "0").filter((F.col("best.pages") >= least) & (F.col("best.pages") * 2 > F.col("all"))).select("book", F.col("best.key").alias("key"), F.lit("").alias("value"))


def _composes(words: Column, lexicon) -> Column:
    @F.pandas_udf("boolean")
    def composes(batch: pd.Series) -> pd.Series:
        known = lexicon.value
        return batch.map(known.composes)

    return composes(words)


def word_readings(words: DataFrame, counts: DataFrame, lexicon, confusions: Confusions, ratio: int = 8, far_ratio: int = 30) -> DataFrame:
    """(word, known, reading) of distinct words: whether the corpus or the lexicon has them, and what they are misreadings of.

    One confusion must lead to a word `ratio` times as frequent (any attested one, where a word holds signs or figures), or to
    one that the lexicon composes and that is attested half as often (as often, if the word only occurs with a capital and so
    may be a name; once, if not at all). Two must lead to a word `far_ratio` times as frequent. Two confusions are found by meeting in the middle: forms
    with one of the word's undone are joined to forms with one made in words of the corpus.
    """
    # a vocabulary is skewed by counts, not by keys: every word is one row here
    words = words.join(counts, "word", "left").withColumn("composed", _composes(F.col("word"), lexicon))
    words = checkpointed(words.withColumns({"n": F.coalesce("n", F.lit(0)), "small": F.coalesce("small", F.lit(0))}))

    def undo(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = lexicon.value
        for batch in batches:
            rows = [(w, n, small == 0 and n > 0, bool(_ODD_SIGN.search(w)), f, len(f) > 4 and known.composes(f)) for w, n, small in zip(batch["word"], batch["n"], batch["small"]) for f in confusions.undone(w)]
            yield pd.DataFrame(rows, columns=["word", "own", "name", "odd", "form", "composed"])

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(f, w, n) for w, n in zip(batch["word"], batch["n"]) for f in confusions.made(w)]
            yield pd.DataFrame(rows, columns=["form", "reading", "n"])

    suspects = words.filter(~F.col("composed") & F.length("word").between(3, MAX_WORD) & ~F.contains("word", F.lit("-")))
    forms = suspects.select("word", "n", "small").mapInPandas(undo, "word string, own long, name boolean, odd boolean, form string, composed boolean")
    attested = counts.filter(F.length("word").between(3, MAX_WORD) & ~F.contains("word", F.lit("-")))
    one = attested.select(F.col("word").alias("form"), F.col("word").alias("reading"), "n", F.lit(1).alias("steps"))
    two = attested.filter("n > 2 AND length(word) > 3").select("word", "n").mapInPandas(make, "form string, reading string, n long").withColumn("steps", F.lit(2))
    own = F.greatest("own", F.lit(1))
    joined = forms.join(one.unionByName(two), "form").filter("reading <> word")
    near = (F.col("steps") == 1) & (F.col("odd") | (F.col("n") >= ratio * own))
    far = (F.col("steps") == 2) & F.when(F.col("odd"), True).otherwise((F.col("n") >= far_ratio * own) & (F.length("word") > 6) & F.col("word").rlike(_VOWEL.pattern))
    lexical = (F.col("steps") == 1) & F.col("composed") & (own <= F.when(F.col("name"), F.col("n")).otherwise(2 * F.col("n")))
    found = joined.select("word", "reading", "n", F.when(near, 3).when(lexical, 2).when(far, 1).alias("rank")).filter("rank IS NOT NULL")
    composed = forms.filter(F.col("composed") & (F.col("own") <= F.when(F.col("name"), 1).otherwise(2))).select("word", F.col("form").alias("reading"), F.lit(1).cast("long").alias("n"), F.lit(2).alias("rank"))
    best = found.unionByName(composed).groupBy("word").agg(F.max(F.struct("rank", "n", "reading")).alias("best")).select("word", F.col("best.reading").alias("reading"))
    return words.join(best, "word", "left").select("word", (F.col("composed") | (F.col("n") > 0)).alias("known"), "reading")


def token_table(seen: DataFrame, counts: DataFrame, lexicon, confusions: Confusions) -> DataFrame:
    """(kind, key, value): tokens that are misread, with how many characters and what they say; codes that are words (kind `code`)."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(t, role, word) for t in batch["key"] for role, word in forms_of_token(t)]
            yield pd.DataFrame(rows, columns=["token", "role", "word"])

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for token, found in zip(batch["token"], batch["found"]):
                roles = {x["role"]: (x["word"], x["known"], x["reading"]) for x in found}
                got = judged_token(token, roles)
                if got:
                    rows.append(("token", token, f"{got[0]} {got[1]}"))
                if roles["w"][1] and not _ODD_SIGN.search(token) and _DICE.fullmatch(token):
                    rows.append(("code", token, ""))
            yield pd.DataFrame(rows, columns=["kind", "key", "value"])

    asked = checkpointed(seen.filter("kind = 'token'").select("key").mapInPandas(ask, "token string, role string, word string"))
    answers = word_readings(asked.select("word").distinct(), counts, lexicon, confusions)
    # only tokens that some reading, or the shape of a dice code, can change
    answered = asked.join(answers, "word")
    doubtful = answered.groupBy("token").agg(F.collect_list(F.struct("role", "word", "known", "reading")).alias("found"), F.max(F.col("reading").isNotNull() | F.col("role").isin("i", "j")).alias("doubt"))
    return doubtful.filter(F.col("doubt") | F.col("token").rlike("^[A-Za-z|!]{1,2}T[A-Za-z|!]{1,3}$")).select("token", "found").mapInPandas(judge, "kind string, key string, value string")


def pair_table(seen: DataFrame, counts: DataFrame, lexicon) -> DataFrame:
    """(key, value) of words broken at line ends: `joined` if the mark isn't part of the word, `kept` if it is, `apart` if it stands for a word left out."""
    part = lambda i: F.split("key", " ").getItem(i)
    pairs = seen.filter("kind = 'pair'").select("key", part(0).alias("left"), part(1).alias("mark"), part(2).alias("right"))
    n = lambda name: counts.select(F.col("word").alias(name), F.col("n").alias(f"{name}_n"))
    pairs = pairs.withColumns({"whole": F.lower(F.concat("left", "right")), "marked": F.lower(F.concat("left", F.lit("-"), "right"))})
    pairs = pairs.join(n("whole"), "whole", "left").join(n("marked"), "marked", "left")
    whole = F.coalesce("whole_n", _composes(F.col("whole"), lexicon).cast("long"))
    marked = F.coalesce("marked_n", F.lit(0))
    capitals = lambda c: (F.col(c) == F.upper(c)) & (F.col(c) != F.lower(c))
    opening = F.substring("right", 1, 1)
    apart = F.lower("right").isin(*_SEPARATE)
    value = (
        F.when(F.col("mark").isin("¬", "\u00ad"), "joined").when(apart & F.col("whole_n").isNull(), "apart").when((marked > 0) & (marked >= whole), "kept").when(whole > 0, "joined")
        .when(capitals("left") & ~capitals("right") | (opening != F.lower(opening)) & ~capitals("left"), "kept").otherwise("joined")
    )
    return pairs.select("key", value.alias("value"))


def learn(texts: DataFrame, corrections: DataFrame, artifacts: DataFrame, titles: DataFrame, headings: DataFrame, words: Collection[str], prefixes: Collection[str]) -> DataFrame:
    """(kind, book, key, value): all that the corpus teaches about the lines, pairs and tokens of the texts.

    texts (book, page, text); corrections (original, corrected), from which the confusions come; artifacts (book, page, text);
    titles and headings (book, text). `words` and `prefixes` are those of a lexicon of fixed size.
    """
    spark = texts.sparkSession
    lexicon = spark.sparkContext.broadcast(Lexicon(frozenset(words), frozenset(prefixes)))
    confusions = Confusions(learn_confusions(corrections))
    seen = checkpointed(observed(texts))
    counts = checkpointed(word_counts(seen))
    lines = artifacts.select("book", "text").unionByName(titles.select("book", "text")).unionByName(headings.select("book", "text"))
    none = F.lit(None).cast("string").alias("book")
    row = lambda df, kind: df.select(F.lit(kind).alias("kind"), "book", "key", "value")
    tokens = token_table(seen, counts, lexicon, confusions).select("kind", none, "key", "value")
    pairs = row(pair_table(seen, counts, lexicon).select("key", "value", none), "pair")
    return checkpointed(row(header_table(seen, lines), "header").unionByName(row(offset_table(seen, artifacts), "offset")).unionByName(pairs).unionByName(tokens))


class Repairer:
    """Repairs one text at a time by rows (kind, book, key, value) of what `learn` found."""

    def __init__(self, rows: Iterable[tuple[str, str | None, str, str]]):
        self.headers: dict[tuple[str | None, str], str] = {}
        self.offsets: dict[str | None, list[int]] = {}
        self.pairs: dict[str, str] = {}
        self.tokens: dict[str, tuple[int, str]] = {}
        self.codes: set[str] = set()
        self.chunks: dict[str, str] = {}
        for kind, book, key, value in rows:
            if kind == "header":
                self.headers[book, key] = value
            elif kind == "offset":
                self.offsets.setdefault(book, []).append(int(key))
            elif kind == "pair":
                self.pairs[key] = value
            elif kind == "code":
                self.codes.add(key)
            else:
                size, reading = value.split(" ", 1)
                self.tokens[key] = (int(size), reading)

    def _dice(self, m: re.Match) -> str:
        code = m[0]
        if re.fullmatch(r"\d+T\d+(?:[+-]\d+)?", code) or code in self.codes:
            return code
        number, sides, extra = ("".join(DICE_FIGURES.get(c, c) for c in x or "") for x in m.groups())
        if number.isdigit() and sides in DICE_SIDES and (not extra or extra[1:].isdigit()):
            return f"{number}T{sides}{extra}"
        return code

    def __call__(self, text: str, book: str | None, page: int | None) -> tuple[str, set[str]]:
        """(the text as readable paragraphs, the kinds of noise it had)."""
        kinds: set[str] = set()
        lines = [x.strip() for x in _LINE.split(plain(text))]
        if len(lines) > 1:
            lines = self._without_edges(lines, book, page, kinds)
        paragraphs: list[str] = []
        for chunks in (p.split(" ") for p in self._joined(lines, kinds)):
            fixed = [self.chunks[c] if c in self.chunks else self._chunk(c) for c in chunks]
            if fixed != chunks:
                kinds.add("misread")
            paragraphs.append(" ".join(fixed))
        return "\n\n".join(paragraphs), kinds

    def _chunk(self, chunk: str) -> str:
        """What a chunk between blanks says; the answer is kept as long as there is room."""
        fixed = _DICE.sub(self._dice, chunk)
        out, last = [], 0
        for m in _TOKEN.finditer(fixed):
            got = self.tokens.get(m[0])
            if got is not None:
                out += [fixed[last : m.start()], got[1]]
                last = m.start() + got[0]
        if len(self.chunks) >= KEPT_CHUNKS:
            self.chunks.clear()
        self.chunks[chunk] = fixed = "".join(out) + fixed[last:]
        return fixed

    def _without_edges(self, lines: list[str], book: str | None, page: int | None, kinds: set[str]) -> list[str]:
        """The lines without headers and page numbers, and without the blank lines around those at the ends."""
        capitals = "".join(lines).isupper()
        # what each line is: blank, number, header, printed (set as a header, but not known as one) or text
        what = [self._what(line, book, page, capitals, kinds) if line else "blank" for line in lines]
        solid = [i for i, w in enumerate(what) if w != "blank"]
        for at, i in enumerate(solid):
            if what[i] != "printed":
                continue
            before = solid[at - 1] if at else None
            after = solid[at + 1] if at + 1 < len(solid) else None
            beside = any(j is not None and what[j] in ("number", "header") for j in (before, after))
            # a line that breaks into a sentence stands at a page edge, and so does one that ends the text: a heading would introduce something
            if beside or before is not None and (after is None or not _SENTENCE_END.search(lines[before])) or after is not None and lines[after][0].islower():
                what[i] = "header"
                kinds.add("header")
        kept = [i for i, w in enumerate(what) if w in ("text", "printed")]
        if len(kept) == len(solid):
            return lines
        gone = ("number", "header")
        out: list[str] = []
        pending, removed = 0, True
        for line, w in zip(lines, what):
            if w == "blank":
                pending += 1
            elif w in gone:
                removed, pending = True, 0 if not out else pending
            else:
                if pending and out and not removed:
                    out.append("")
                out.append(line)
                pending, removed = 0, False
        return out

    def _what(self, line: str, book: str | None, page: int | None, capitals: bool, kinds: set[str]) -> str:
        offsets = self.offsets.get(book, ())
        number, rest = False, line
        for digits, beside in page_options(line):
            if is_page(digits, page, offsets):
                if not beside:
                    kinds.add("page_number")
                    return "number"
                number, rest = True, beside
                break
        if not may_be_header(rest, number):
            return "text"
        keys = header_parts(rest)
        known = {self.headers[book, k] for k in keys if (book, k) in self.headers}
        opening = next(c for c in rest if c.isalpha())
        printed = looks_printed(rest) and not (capitals and rest.isupper())
        if "seed" in known or "repeat" in known and printed or number and keys and (opening.isupper() or rest[0] in "~–-"):
            kinds.add("header")
            if number:
                kinds.add("page_number")
            return "header"
        return "printed" if printed else "text"

    def _joined(self, lines: list[str], kinds: set[str]) -> list[str]:
        """Paragraphs of the lines, words broken at line ends closed up."""
        paragraphs: list[list[str]] = [[]]
        for line in lines:
            if not line:
                if paragraphs[-1]:
                    paragraphs.append([])
                continue
            current = paragraphs[-1]
            if not current:
                current.append(line)
                continue
            end = current[-1]
            m = end[-1] in _MARKS and _LEFT_PART.search(end[-MAX_WORD:])
            first = m and m[1][-1].isalpha() and _FIRST_WORD.match(line)
            if not first:
                current += [" ", line]
                continue
            how = self.pairs.get(f"{m[1]} {m[2]} {first[0]}", "joined")
            if how == "joined":
                kinds.add("hyphen")
                current[-1] = end[:-1]
                current.append(line)
            else:
                current += [" ", line] if how == "apart" or first[0].lower() in _SEPARATE else [line]
        return ["".join(p) for p in paragraphs if p]


def repair_texts(texts: DataFrame, learnt: DataFrame, max_rows: int = 500_000, skip=None, only_noisy: bool = False, block_rows: int = 2_000) -> DataFrame:
    """(field, rec_id, repaired, kinds) for texts (field, rec_id, book, page, text) by the table that `learn` made of them.

    Up to `max_rows` learnt rows are broadcast; more are joined to blocks of about `block_rows` texts, each of which gets only
    the rows that its own lines, pairs and tokens ask for. `skip`, if given, is a function from a batch of texts to a list of
    booleans; texts it marks are left out. With `only_noisy`, texts without noise are left out, before `skip` is asked, and
    `repaired` is null: a cheaper plan where only the kinds are wanted. Cases: null texts have no row; empty ones are returned
    as they are, without noise; an unknown page lets any lone number count as its number; an unknown book has no headers of
    its own; a text of one line holds no header or page number, as none of its lines is inside it; repeated rows each get a row.
    """
    spark = texts.sparkSession
    schema = f"field string, rec_id {texts.schema['rec_id'].dataType.simpleString()}, repaired string, kinds array<string>"
    source = texts.filter(F.col("text").isNotNull()).select("field", "rec_id", "book", F.col("page").cast("int").alias("page"), "text")
    rows = bounded_rows(learnt.select("kind", "book", "key", "value"), max_rows)
    if rows is not None:
        return source.mapInPandas(partial(_repair_batches, spark.sparkContext.broadcast([tuple(r) for r in rows]), skip, only_noisy), schema)
    blocks = max(1, -(-source.count() // block_rows))
    source = source.withColumn("block", F.pmod(F.xxhash64("field", "rec_id", "text"), F.lit(blocks)))
    asked = source.select("block", "book", "page", "text").mapInPandas(_ask_batches, "block long, kind string, book string, key string").distinct()
    same = ["kind", "key"]
    asks = asked.filter("kind <> 'offset'").withColumnRenamed("book", "asker").join(learnt.filter("kind <> 'offset'"), same).filter(F.col("book").isNull() | (F.col("book") == F.col("asker"))).select("block", "kind", "book", "key", "value")
    offsets = asked.filter("kind = 'offset'").select("block", "book").join(learnt.filter("kind = 'offset'"), "book").select("block", "kind", "book", "key", "value")
    answers = asks.unionByName(offsets).distinct()
    return source.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(lambda left, right: pd.concat([x for x in _repaired(Repairer(right[["kind", "book", "key", "value"]].astype(object).where(right.notna(), None).itertuples(index=False)), [left], skip, only_noisy)]), schema)


def _ask_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = set()
        for block, book, page, text in zip(batch["block"], batch["book"].astype(object), batch["page"], batch["text"]):
            if not text or text.isspace():
                continue
            chunks: Counter[str] = Counter()
            others: dict = {}
            book = None if pd.isna(book) else book
            observe(text, book, None if pd.isna(page) else int(page), chunks, others)
            tokens = {*tokens_of(chunks), *(key for kind, _, key, _ in others if kind == "token")}
            rows.update((block, "token", None, t) for t in tokens)
            rows.update((block, "code", None, t) for t in tokens if _DICE.fullmatch(t))
            rows.update((block, {"line": "header"}.get(kind, kind), b, key) for kind, b, key, _ in others if kind in ("line", "pair"))
            rows.add((block, "offset", book, ""))
        yield pd.DataFrame(list(rows), columns=["block", "kind", "book", "key"])


_LAST: list = [None, None]


def _repair_batches(shared, skip, only_noisy: bool, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    if _LAST[0] is not shared.value:  # a Python worker that runs several tasks keeps its tables
        _LAST[:] = [shared.value, Repairer(shared.value)]
    yield from _repaired(_LAST[1], batches, skip, only_noisy)


def _repaired(repairer: Repairer, batches: Iterable[pd.DataFrame], skip, only_noisy: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if skip is not None and not only_noisy:
            batch = batch[[not s for s in skip(batch)]]
        rows, at = [], []
        pages = batch["page"].astype("object").where(batch["page"].notna(), None)
        books = batch["book"].astype("object").where(batch["book"].notna(), None)
        for i, (field, rec, page, text, book) in enumerate(zip(batch["field"], batch["rec_id"], pages, batch["text"], books)):
            repaired, kinds = repairer(text, book, None if page is None else int(page))
            if kinds or not only_noisy:
                rows.append((field, rec, None if only_noisy else repaired, sorted(kinds)))
                at.append(i)
        out = pd.DataFrame(rows, columns=["field", "rec_id", "repaired", "kinds"])
        if skip is not None and only_noisy and rows:
            out = out[[not s for s in skip(batch.iloc[at])]]
        yield out
