"""Splitting of texts above a size limit by lexical cohesion.

Between neighbouring sentences or lines, the words of a block before and a block after are compared; where the similarity
has a deep valley the topic changes. Within the window in which a piece may end, the deepest valley is chosen; the next
piece begins so far back that both share the overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvarto.llm.tokens import VOCABULARY, token_count, token_ends

#: where a text may be cut: after a blank line, a line, a sentence
_BOUNDARY = re.compile(r"(?:\r\n|\r|\n)(?:[ \t]*(?:\r\n|\r|\n))*|(?<=[.!?…])[\"”'’)]*[ \t]+(?=[\"”A-ZÅÄÖÆØ0-9-])")
_WORD = re.compile(r"[^\W\d_]{4,}")


def gaps(text: str) -> list[tuple[int, int]]:
    """(position, strength) of natural boundaries: 3 after a blank line, 2 after a line, 1 after a sentence."""
    out = []
    for m in _BOUNDARY.finditer(text):
        breaks = m[0].count("\n") or m[0].count("\r")
        if 0 < m.end() < len(text):
            out.append((m.end(), 3 if breaks > 1 else 2 if breaks else 1))
    return out


def cohesion(text: str, cuts: list[int], block: int = 60) -> np.ndarray:
    """Cosine similarity of the `block` words before and after each cut, updated from cut to cut."""
    starts, stems = [], []
    ids: dict[str, int] = {}
    for m in _WORD.finditer(text):
        starts.append(m.start())
        stems.append(ids.setdefault(m[0][:6].lower(), len(ids)))
    left, right = [0] * len(ids), [0] * len(ids)
    dot = ll = rr = 0
    a = m = b = 0  # words a..m lie left of the cut, m..b right of it
    out = np.zeros(len(cuts))
    places = np.searchsorted(starts, cuts) if starts else np.zeros(len(cuts), int)
    for i, cut in enumerate(places.tolist()):
        while b < min(cut + block, len(stems)):
            w = stems[b]
            rr += 2 * right[w] + 1
            dot += left[w]
            right[w] += 1
            b += 1
        while m < cut:
            w = stems[m]
            rr -= 2 * right[w] - 1
            dot -= left[w]
            right[w] -= 1
            ll += 2 * left[w] + 1
            dot += right[w]
            left[w] += 1
            m += 1
        while a < cut - block:
            w = stems[a]
            ll -= 2 * left[w] - 1
            dot -= right[w]
            left[w] -= 1
            a += 1
        out[i] = dot / (ll * rr) ** 0.5 if ll and rr else 0.0
    return out


def depths(similarity: np.ndarray) -> np.ndarray:
    """How deep each place lies below the nearest peaks on both sides."""
    n = len(similarity)
    left, right = similarity.copy(), similarity.copy()
    for i in range(1, n):
        if similarity[i - 1] >= similarity[i]:
            left[i] = left[i - 1]
    for i in range(n - 2, -1, -1):
        if similarity[i + 1] >= similarity[i]:
            right[i] = right[i + 1]
    return left + right - 2 * similarity


def split_text(text: str, capacity: int, overlap: int, path: str = VOCABULARY, block: int = 60, least: float = 0.5) -> list[tuple[int, int, int, str]]:
    """(begin, end, tokens, kind of the cut at the end) of the pieces of a text; one piece if it fits.

    A piece holds at most `capacity` tokens when it stands alone; consecutive pieces share at least `overlap` tokens, but for
    what a boundary inside a character or a long word needs. Cuts fall on natural boundaries, else between words, else
    between tokens.
    """
    if not 0 <= overlap < capacity / 2:
        raise ValueError("the overlap must be less than half the capacity")
    ends = token_ends(text, path)
    if len(ends) <= capacity:
        return [(0, len(text), len(ends), "end")]
    found = gaps(text)
    cuts = np.array([p for p, _ in found], dtype=np.int64)
    strength = np.array([s for _, s in found])
    depth = depths(cohesion(text, cuts.tolist(), block)) + 0.05 * strength if len(cuts) else np.zeros(0)
    index = np.searchsorted(ends, cuts, side="left") + 1 if len(cuts) else cuts  # tokens up to each cut
    pieces, begin = [], 0
    while True:
        first = int(np.searchsorted(ends, begin, side="right"))  # the token that holds the first character
        if len(ends) - first <= capacity:
            n = token_count(text[begin:], path)
            if n <= capacity:
                pieces.append((begin, len(text), n, "end"))
                return pieces
        room = capacity
        while True:
            low, high = np.searchsorted(index, [first + max(overlap + 1, int(room * least)), first + room], side="left")
            while high < len(index) and index[high] <= first + room:
                high += 1
            if low < high:
                at = low + int(np.argmax(depth[low:high]))
                end, kind = int(cuts[at]), ("", "sentence", "line", "paragraph")[strength[at]]
            else:
                stop = int(ends[min(first + room, len(ends)) - 1])
                space = max(text.rfind(" ", begin, stop), text.rfind("\t", begin, stop))
                floor = int(ends[first + max(overlap + 1, int(room * least)) - 1])
                end, kind = (space + 1, "word") if space + 1 > floor else (stop, "token")
            n = token_count(text[begin:end], path)
            if n <= capacity:
                break
            room -= n - capacity + 1
        pieces.append((begin, end, n, kind))
        if end >= len(text):
            return pieces
        last = int(np.searchsorted(ends, end, side="left")) + 1  # tokens up to the end
        back = int(ends[max(first, last - overlap - 1)]) if last - overlap - 1 >= 0 else 0
        if overlap == 0:
            begin = end
            continue
        # back to the start of a word, if one is near
        near = max(text.rfind(" ", max(begin + 1, back - 60), back + 1), text.rfind("\n", max(begin + 1, back - 60), back + 1))
        begin = max(begin + 1, near if near > begin else back)


def split_documents(df: DataFrame, id_col: str, text_col: str, capacity: int, overlap: int, path: str = VOCABULARY) -> DataFrame:
    """(id, piece, pieces, begin, end, tokens, cut) of every text above the capacity.

    Cases: null and empty texts, and texts that fit, have no pieces; a text of bytes no more than the capacity can't exceed it
    and isn't tokenized; texts without boundaries are cut between tokens; repeated ids are cut each for itself.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    large = df.filter(F.octet_length(F.col(f"`{text_col}`")) > capacity).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["id", "piece", "pieces", "begin", "end", "tokens", "cut"]
        for batch in batches:
            rows = []
            for ident, text in zip(batch["id"].astype(object), batch["text"]):
                pieces = split_text(text, capacity, overlap, path)
                if len(pieces) > 1:
                    rows.extend((None if pd.isna(ident) else ident, i, len(pieces), *p) for i, p in enumerate(pieces))
            yield pd.DataFrame(rows, columns=columns)

    return large.mapInPandas(cut, f"id {id_type}, piece int, pieces int, begin long, end long, tokens int, cut string")
