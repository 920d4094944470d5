"""Deeply nested JSON payloads as related flat tables.

A payload becomes an adjacency table: a row for each node with its parent, the
label under which the parent holds it, its ordinal there and, where it has no
children, its scalar. A string that spells a JSON object or array is both: it
keeps its scalar and has what it spells as children.

What is a member of a collection is found by joins on that table: collections
are the nodes of the wanted names below records, members are the object nodes
below collections. Their scalar children are joined to them and pivoted into
one entity table a kind, whose keys link children to parents.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.common import durable

#: The collections of each source: collection name, kind of its members, and the kind whose members may hold it besides the root.
COLLECTIONS = {
    "parse_results": (("pages", "page", None), ("visualelements", "visual_element", "page")),
    "segment_debug": (("vlmresults", "vlm_result", None),),
}
#: The scalar children that become columns of each entity table.
ENTITY_COLUMNS = {
    "page": ("page_number", "text", "confidence_score"),
    "visual_element": ("element_type", "content_hash", "vlm_description", "confidence", "page_or_slide"),
    "vlm_result": ("model", "confidence", "description"),
}
#: Names under which an envelope holds the record itself.
ENVELOPES = frozenset({"result", "results", "debug", "data", "payload", "response", "record", "output", "body"})

#: ``payload_id`` is unique for each payload; ``shape`` is what a node holds, ``node_kind`` how it is written; ``n_filled`` counts children that are not null, ``n_objects`` those that hold objects.
NODE_SCHEMA = (
    "payload_id bigint, row_id {id}, node_id int, parent_id int, label string, parent_label string, ordinal int, depth int, node_kind string, shape string, scalar string, n_children int, n_filled int, n_objects int"
)
_SCANNED = re.compile(r"[ \t\n\r]*")
_BARE = re.compile(r"(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?|true|false|null|NaN|-?Infinity)")


def plain(name: str) -> str:
    """A name without case, underscores and hyphens, so that all spellings of one name are equal."""
    return re.sub(r"[^0-9a-z]", "", name.lower())


def _plain(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^0-9a-z]", "")


def _deep_loads(text: str) -> Any:
    """As ``json.loads``, for texts nested deeper than it can go: open containers are kept in a list."""
    top: list[Any] = []
    # Open containers, each with the name under which an object's next value goes.
    open_: list[tuple[Any, str | None]] = [(top, None)]
    at, value_next = 0, True
    while True:
        at = _SCANNED.match(text, at).end()
        if at >= len(text):
            break
        inside, name = open_[-1]
        if value_next:
            sign = text[at]
            if sign in "]}" and inside is not top and not inside and (sign == "]") == isinstance(inside, list) and name is None:
                open_.pop()
                at, value_next = at + 1, False
                continue
            if isinstance(inside, dict) and name is None:
                if sign != '"':
                    raise ValueError(f"name expected at {at}")
                name, at = json.decoder.scanstring(text, at + 1, False)
                at = _SCANNED.match(text, at).end()
                if text[at : at + 1] != ":":
                    raise ValueError(f"colon expected at {at}")
                open_[-1], at = (inside, name), at + 1
                continue
            if sign == '"':
                value, at = json.decoder.scanstring(text, at + 1, False)
            elif sign in "[{":
                value, at = ([] if sign == "[" else {}), at + 1
            elif bare := _BARE.match(text, at):
                value, at = json.loads(bare.group()), bare.end()
            else:
                raise ValueError(f"value expected at {at}")
            if isinstance(inside, list):
                inside.append(value)
            else:
                inside[name] = value
                open_[-1] = (inside, None)
            if sign in "[{":
                open_.append((value, None))
            else:
                value_next = False
        elif inside is not top and text[at] == ",":
            at, value_next = at + 1, True
        elif inside is not top and text[at] == ("]" if isinstance(inside, list) else "}"):
            open_.pop()
            at += 1
        else:
            raise ValueError(f"end expected at {at}")
    if len(open_) > 1 or not top:
        raise ValueError("the text ends too early")
    return top[0]


def _loads(text: str) -> Any:
    try:
        return json.loads(text)
    except RecursionError:
        pass
    except ValueError:
        return None
    try:
        return _deep_loads(text)
    except ValueError:
        return None


def unpack(value: Any) -> Any:
    """``value``, or what it spells if it is a string holding a JSON object or array, however often encoded."""
    found = value
    # Each step makes the string shorter.
    while isinstance(found, str) and found.lstrip()[:1] in ("{", "[", '"'):
        found = _loads(found)
    return found if isinstance(found, (dict, list)) else value


def records(value: Any, wanted: frozenset[str]) -> Iterator[dict]:
    """The records that a payload holds: itself, or what its envelopes hold, however deep."""
    stack: list[tuple[Any, bool]] = [(value, False)]
    while stack:
        value, is_rest = stack.pop()
        value = unpack(value)
        if isinstance(value, list):
            stack += [(entry, False) for entry in reversed(value)]
        elif isinstance(value, dict):
            inside = [] if is_rest or any(plain(k) in wanted for k in value) else [k for k, v in value.items() if plain(k) in ENVELOPES and isinstance(unpack(v), (dict, list))]
            if not inside:
                yield value
                continue
            # What stands beside the record in its envelope is kept as a record of its own, which has no members.
            if rest := {k: v for k, v in value.items() if k not in inside}:
                stack.append((rest, True))
            stack += [(value[k], False) for k in reversed(inside)]


def shred_payload(payload: str | None, wanted: frozenset[str], labels: frozenset[str] | None = None) -> list[tuple]:
    """The adjacency rows of one payload, from ``node_id`` on; none for null, for what is no JSON and for a bare scalar.

    ``wanted`` names the collections by which a record is known. With ``labels``
    only records, nodes of a wanted name or below one, and scalars of these
    labels come out, with the same ids.
    """
    parsed = unpack(_loads(payload)) if payload else None
    if not isinstance(parsed, (dict, list)):
        return []
    rows: list[tuple] = []
    # A stack instead of recursion: payloads may be nested deeper than Python allows.
    stack: list[tuple] = [(r, None, "$", None, n, 0) for n, r in enumerate(records(parsed, wanted))][::-1]
    me = -1
    while stack:
        value, parent, label, above, ordinal, depth = stack.pop()
        me += 1
        written, held = value, unpack(value)
        if isinstance(held, dict):
            shape, children = "object", list(held.items())
        elif isinstance(held, list):
            shape, children = "array", [(str(n), v) for n, v in enumerate(held)]
        else:
            shape, children = "null" if held is None else "string" if isinstance(held, str) else "boolean" if isinstance(held, bool) else "number", []
        kind = "string" if isinstance(written, str) else shape
        scalar = written if kind == "string" else json.dumps(written) if kind in ("number", "boolean") else None
        name = plain(label)
        if labels is None or depth == 0 or name in wanted or (above is not None and above in wanted) or (scalar is not None and name in labels):
            unpacked = [unpack(v) for _, v in children]
            rows.append((me, parent, label, above, ordinal, depth, kind, shape, scalar, len(children), sum(v is not None for v in unpacked), sum(isinstance(v, dict) for v in unpacked)))
        stack += [(child, me, key, name, n, depth + 1) for n, (key, child) in reversed(list(enumerate(children)))]
    return rows


def adjacency(df: DataFrame, source: str, id_col: str, payload_col: str = "payload", members_only: bool = False) -> DataFrame:
    """The adjacency table of all payloads of ``df``, with columns as in ``NODE_SCHEMA``.

    Null payloads and payloads that are no JSON give no rows. Repeated rows
    give their nodes each time, under another ``payload_id``. With
    ``members_only`` only what the entity tables need comes out.
    """
    kind = df.schema[id_col].dataType.simpleString()
    collections = COLLECTIONS[source]
    wanted = frozenset(name for name, _, _ in collections)
    labels = frozenset(plain(c) for _, k, _ in collections for c in ENTITY_COLUMNS[k]) if members_only else None
    types = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32())
    names = [c.split()[0] for c in NODE_SCHEMA.split(", ")]

    def shred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at = [], []
            for n, payload in enumerate(batch.column("body").to_pylist()):
                found = shred_payload(payload, wanted, labels)
                rows += found
                at += [n] * len(found)
            columns = zip(*rows, strict=True) if rows else [()] * len(types)
            spots = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("payload_id").take(spots), batch.column("row_id").take(spots), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names)

    return df.select(F.monotonically_increasing_id().alias("payload_id"), F.col(id_col).alias("row_id"), F.col(payload_col).alias("body")).mapInArrow(shred, NODE_SCHEMA.format(id=kind))


def _members(nodes: DataFrame, owners: DataFrame, collection: str) -> DataFrame:
    """Member nodes, ``(payload_id, row_id, node_id, parent_key, child_key)``, of the collections of a name below ``owners`` (``payload_id, node_id, key``).

    Array: non-empty objects at their 0-based position, all entries counted.
    Object whose non-null values are all objects: its names. Any other non-empty
    object stands alone for the collection, with key ``0``.
    """
    below = nodes.where(_plain(F.col("label")) == collection).withColumnRenamed("parent_id", "owner_id")
    held = below.join(owners.withColumnRenamed("node_id", "owner_id"), ["payload_id", "owner_id"])
    named = (F.col("shape") == "object") & (F.col("n_objects") == F.col("n_filled"))
    is_filled = (F.col("shape") == "object") & (F.col("n_children") > 0)
    lone = held.where(is_filled & ~named).select("payload_id", "row_id", "node_id", F.col("key").alias("parent_key"), F.lit("0").alias("child_key"))
    many = held.where((F.col("shape") == "array") | named).select("payload_id", F.col("node_id").alias("parent_id"), F.col("key").alias("parent_key"))
    entries = nodes.where(is_filled & (_plain(F.col("parent_label")) == collection)).select("payload_id", "row_id", "node_id", "parent_id", F.col("label").alias("child_key"))
    return lone.unionByName(many.join(entries, ["payload_id", "parent_id"]).select("payload_id", "row_id", "node_id", "parent_key", "child_key"))


def _pivoted(members: DataFrame, nodes: DataFrame, kind: str) -> DataFrame:
    columns = ENTITY_COLUMNS[kind]
    scalars = nodes.where(F.col("scalar").isNotNull()).select("payload_id", F.col("parent_id").alias("node_id"), _plain(F.col("label")).alias("label"), "scalar")
    scalars = scalars.where(F.col("label").isin([plain(c) for c in columns]))
    picks = [F.max(F.when(F.col("label") == plain(c), F.col("scalar"))).alias(c) for c in columns]
    return members.join(scalars, ["payload_id", "node_id"], "left").groupBy("payload_id", "row_id", "node_id", "parent_key", "child_key").agg(*picks)


def entities(nodes: DataFrame, source: str) -> dict[str, DataFrame]:
    """The entity tables of a source by kind: ``(payload_id, row_id, node_id, parent_key, child_key, <scalars>)``, all scalars as strings.

    Member nodes are joined with their scalar children and pivoted; a scalar
    missing or null in an object is null. Of one name in two spellings the
    greater value is taken. ``parent_key`` is the ``child_key`` of the member
    that holds the collection, ``root`` below the record.
    """
    roots = nodes.where("depth = 0 AND shape = 'object'").select("payload_id", "node_id", F.lit("root").alias("key"))
    out: dict[str, DataFrame] = {}
    members: dict[str, DataFrame] = {}
    for collection, kind, above in COLLECTIONS[source]:
        owners = roots if above is None else roots.unionByName(members[above].select("payload_id", "node_id", F.col("child_key").alias("key")))
        members[kind] = _members(nodes, owners, collection)
        out[kind] = _pivoted(members[kind], nodes, kind)
    return out


def shredded(df: DataFrame, source: str, id_col: str, payload_col: str = "payload") -> dict[str, DataFrame]:
    """The entity tables of ``df``'s payloads; payloads are parsed once, and what members need of them is written once."""
    return entities(durable(adjacency(df, source, id_col, payload_col, members_only=True)), source)


def found_members(tables: dict[str, DataFrame], source: str) -> DataFrame:
    """``(source_table, row_id, child_kind, parent_key, child_key)``: a row for each row of the entity tables."""
    parts = [t.select(F.lit(source).alias("source_table"), "row_id", F.lit(kind).alias("child_kind"), "parent_key", "child_key") for kind, t in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
