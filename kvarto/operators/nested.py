"""Flattening of deeply nested JSON records into related tables by interval labels.

A depth-first walk gives every node of a document a pre-order and a post-order number. Node b lies inside node a exactly when
pre(a) < pre(b) and post(b) < post(a). The walk only labels and classifies nodes; parents are found afterwards from the
intervals alone, in one pass over each document's nodes in pre-order (no join of a document with itself).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: kind -> (kind of the enclosing record or None, field name that holds the records, whether arrays are records too)
BOOK_KINDS: dict[str, tuple[str | None, str, bool]] = {
    "page": (None, "pages", False),
    "element": ("page", "elements", False),
    "correction": ("element", "corrections", False),
    "row": ("element", "rows", True),
}
NODE_SCHEMA = "doc long, kind string, pos int, pre int, post int, depth int, body string"


def _no_constant(name: str):
    raise ValueError(f"not JSON: {name}")


def parse_json(text: str | None):
    """The value of a strictly valid JSON text (no NaN or Infinity), else ValueError. Nesting beyond the parser's depth counts as damaged."""
    if text is None:
        raise ValueError("null")
    try:
        return json.loads(text, parse_constant=_no_constant)
    except RecursionError as e:
        raise ValueError("nested too deeply") from e


def label(value, kinds: Mapping[str, tuple[str | None, str, bool]], with_body: bool) -> Iterator[tuple]:
    """(kind, pos, pre, post, depth, body) of each record in a parsed document, numbered over all its nodes."""
    holders = {}
    for kind, (parent, field, arrays) in kinds.items():
        holders[parent, field] = (kind, arrays)
    out: list[list] = []
    pre = post = 0
    # a stack entry is (value, kind of the innermost record, record slot or -1, depth, leaving, (kind, arrays) if the entries of the value are records)
    stack: list[tuple] = [(value, None, -1, 0, False, None)]
    while stack:
        node, inside, slot, depth, leaving, held = stack.pop()
        if leaving:
            if slot >= 0:
                out[slot][3] = post
            post += 1
            continue
        if slot >= 0:
            out[slot][2] = pre
        pre += 1
        if not isinstance(node, (dict, list)):
            post += 1
            continue
        stack.append((node, inside, slot, depth, True, None))
        below: list[tuple] = []
        if isinstance(node, dict):
            for field, child in node.items():
                got = holders.get((inside, field))
                if got is not None and isinstance(child, dict):
                    out.append([got[0], 0, 0, 0, depth + 1, _body(child, kinds, got[0]) if with_body else None])
                    below.append((child, got[0], len(out) - 1, depth + 1, False, None))
                else:
                    below.append((child, inside, -1, depth + 1, False, got if isinstance(child, list) else None))
        else:
            for pos, entry in enumerate(node):
                if held is not None and (isinstance(entry, dict) or held[1] and isinstance(entry, list)):
                    out.append([held[0], pos, 0, 0, depth + 1, _body(entry, kinds, held[0]) if with_body else None])
                    below.append((entry, held[0], len(out) - 1, depth + 1, False, None))
                else:
                    below.append((entry, inside, -1, depth + 1, False, None))
        stack.extend(reversed(below))
    return (tuple(x) for x in out)


def _body(record, kinds: Mapping, kind: str) -> str:
    """The record's own part as JSON: its fields without the records it holds."""
    own = {field for parent, field, _ in kinds.values() if parent == kind}
    if isinstance(record, dict):
        record = {k: v for k, v in record.items() if k not in own}
    return json.dumps(record, ensure_ascii=False)


def labelled_nodes(df: DataFrame, id_col: str, json_col: str, kinds: Mapping = BOOK_KINDS, with_body: bool = False) -> DataFrame:
    """Node table of all documents: id, doc, kind, pos, pre, post, depth, body.

    `doc` is a hash of the text, the same in every run; a repeated id with another text is another document. `linked_nodes`
    numbers the copies of a row that is there more than once, so (id, doc, copy, pre) is the key of a record. Null, empty and damaged texts have no nodes; null
    entries of an array keep their position but aren't records; a lone object where an array is expected has position 0;
    records of unexpected type (a text where an object belongs) aren't records. Other columns are not read.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    numbered = df.select(F.xxhash64(F.col(f"`{json_col}`")).alias("doc"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{json_col}`").alias("text"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["id", "doc", "kind", "pos", "pre", "post", "depth", "body"]
        for batch in batches:
            rows = []
            for doc, key, text in zip(batch["doc"], batch["id"].astype(object), batch["text"]):
                try:
                    value = parse_json(text)
                except ValueError:
                    continue
                rows.extend((None if pd.isna(key) else key, doc, *x) for x in label(value, kinds, with_body))
            yield pd.DataFrame(rows, columns=columns)

    return numbered.mapInPandas(walk, f"id {id_type}, {NODE_SCHEMA}")


def damaged(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, reason) of texts that aren't valid JSON."""
    id_type = df.schema[id_col].dataType.simpleString()

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["id"].astype(object), batch["text"]):
                try:
                    parse_json(text)
                except ValueError as e:
                    rows.append((None if pd.isna(key) else key, "null" if text is None else "too deep" if "deeply" in str(e) else "not JSON"))
            yield pd.DataFrame(rows, columns=["id", "reason"])

    return df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{json_col}`").alias("text")).mapInPandas(look, f"id {id_type}, reason string")


def enclosing(kind: str, value: Column, over: Window) -> Column:
    """`value` of the nearest record of a kind whose interval contains this node, else null."""
    last = F.last(F.when(F.col("kind") == kind, F.struct(F.col("post"), value.alias("value"))), ignorenulls=True).over(over)
    return F.when(last["post"] > F.col("post"), last["value"])


def linked_nodes(nodes: DataFrame, kinds: Mapping = BOOK_KINDS) -> DataFrame:
    """Each node with its `copy` and, for every kind that can enclose it, that record's `<kind>_pre` (its key within the document) and `<kind>_pos`.

    Copies of a document have the same intervals, so a node is linked by its place in pre-order whichever copy the enclosing
    node is read from; one exchange by document serves the links and the numbers of the copies.
    """
    before = Window.partitionBy("id", "doc").orderBy("pre").rangeBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy("id", "doc", "pre").orderBy("pre")
    parents = dict.fromkeys(p for p, _, _ in kinds.values() if p)
    return nodes.withColumns({f"{p}_{what}": enclosing(p, F.col(what), before) for p in parents for what in ("pre", "pos")}).withColumn("copy", F.row_number().over(same))


def flat_table(nodes: DataFrame, kind: str, fields: Mapping[str, str], kinds: Mapping = BOOK_KINDS) -> DataFrame:
    """The flat table of one kind: id, doc, copy, the record's key and position, its parent's key, and chosen JSON paths of the body as text columns.

    (id, doc, copy, `<parent>_key`) is found in the parent's table as (id, doc, copy, `<kind>_key`), whichever run made either.
    """
    parent = kinds[kind][0]
    link = [F.col(f"{parent}_pre").alias(f"{parent}_key")] if parent else []
    rows = linked_nodes(nodes, kinds).filter(F.col("kind") == kind)
    return rows.select("id", "doc", "copy", F.col("pre").alias(f"{kind}_key"), F.col("pos").alias(f"{kind}_position"), *link, *[F.get_json_object("body", path).alias(name) for name, path in fields.items()])
