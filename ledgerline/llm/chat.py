"""Chat formatting over a prefix tree.

Conversations that begin with the same turns share the nodes of those turns. A node
is a turn after a given history; it is named by a digest of the whole path. Each
node's formatted text is stored once, in depth-first order of the tree, with

- ``offset``: where its text begins in its partition of the emitted stream
  (``part``), so a batch maker can read the stream as it lies;
- ``position``: the position id of its first code point, which counts along the
  path, not along the stream;
- ``ancestors``: the (part, from, to) intervals of the path above it, to which its code
  points attend, next to the earlier ones of its own interval; turns that lie one behind
  the other in the stream make one interval, so a long path has few;
- ``loss_from``/``loss_to``: the interval of its text that carries loss (assistant
  turns), counted within the node.

Depth-first order is the order of paths as lists of digests, so the stream is
range-partitioned by path: no tree needs to fit into one task, even if all
conversations begin alike. A task lays its part out in one pass, with the current path as
its only state; turns above its first node lie in earlier parts and are looked up
once a part. Equal paths are combined before any shuffle of texts.

Template: ``<s>[role]text</s>``. In roles and texts ``&``, ``<``, ``[`` and ``]`` are written as
character references, so no control string can occur inside; the reverse
replacement restores them.

Defined results: null texts and roles are empty; turns are taken in the order of
turn, role and text, null turns first; turn numbers may repeat or have gaps; rows
with a null conversation id are one conversation; other columns are ignored; no
rows make no nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import discard, written

#: What stands for the characters that control strings are made of.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), ("]", "&#93;"))
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    for char, code in ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for char, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def _name(path: Column) -> Column:
    """120 bits of a digest in 20 characters: paths are lists of names, so short ones count."""
    return F.base64(F.unhex(F.substring(F.sha2(path, 256), 1, 30)))


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, turns: array of (role, text), path: array of node names.

    A conversation is one row; its turns are hashed one after the other.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    lists = turns.select(F.col("conv_id").cast("long").alias("conv_id"),
                         F.struct(F.col("turn").cast("long").alias("turn"), text("role").alias("role"),
                                  text("text").alias("text")).alias("t")) \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def names(t: Column) -> Column:
        step = lambda acc, x: F.concat(acc, F.array(_name(F.concat(
            F.coalesce(F.get(acc, F.size(acc) - 1), F.lit("")), F.lit("\n"), escape(x["role"]),
            F.lit("]"), escape(x["text"])))))
        return F.aggregate(t, F.array().cast("array<string>"), step)

    return lists.select("conv_id", "turns", names(F.col("turns")).alias("path"))


def segment(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<s>["), escape(role), F.lit("]"), escape(text), F.lit("</s>"))


def tree(paths_: DataFrame) -> DataFrame:
    """Nodes in depth-first order, each once; see the module's text for the columns."""
    spark = paths_.sparkSession
    each = paths_.select("path", F.posexplode("turns").alias("k", "t"))
    role, text = F.col("t.role"), F.col("t.text")
    head = F.concat(F.lit("<s>["), escape(role), F.lit("]"))
    loss = role == LOSS_ROLE
    # The path above is part of a node's name, so any row of a name is the node.
    nodes = each.select(
        F.get("path", F.col("k")).alias("node"),
        F.slice("path", F.lit(1), F.col("k") + 1).alias("path"), (F.col("k") + 1).alias("depth"),
        segment(role, text).alias("segment"),
        F.when(loss, F.length(head)).alias("loss_from"),
        F.when(loss, F.length(head) + F.length(escape(text))).alias("loss_to"))
    nodes = written(nodes.groupBy("node").agg(
        F.count(F.lit(1)).alias("conversations"),
        *[F.first(c).alias(c) for c in ("path", "depth", "segment", "loss_from", "loss_to")])
        .withColumn("size", F.length("segment").cast("long")), "chat-nodes")

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (nodes.select("node", "size", "depth", "path").repartitionByRange(width, "path")
               .sortWithinPartitions("path").select("node", "size", "depth"))
    places = written(ordered.mapInArrow(_lay, PLACES), "chat-places")
    # The path above the first node of a part, laid out by earlier parts: a list for each part.
    heads = places.filter("offset = 0").select("part", "node").join(
        nodes.select("node", "path"), "node").select(
        "part", "node", F.posexplode("path").alias("k", "up")).filter("up <> node")
    there = places.select(F.col("node").alias("up"), F.struct(
        "part", F.col("offset").alias("from"), (F.col("offset") + F.col("size")).alias("to"))
        .alias("span"))
    borders = heads.join(there, "up").groupBy("part").agg(
        F.sort_array(F.collect_list(F.struct("k", "span"))).alias("border"))
    lent = F.slice(F.transform("border", lambda x: x["span"]), F.lit(1), F.col("lent"))
    lent = F.when(F.col("lent") > 0, lent).otherwise(F.array().cast(SPANS))
    places_ = places.join(borders, "part", "left").withColumn("lent_spans", lent).select(
        "node", "part", "offset", F.aggregate(
            "lent_spans", F.col("position"), lambda n, x: n + x["to"] - x["from"]).alias("position"),
        F.aggregate(F.concat("lent_spans", "spans"), F.array().cast(SPANS), _joined).alias("ancestors"))
    laid = written(nodes.drop("path").join(places_, "node"), "chat-laid")
    discard(nodes, places)
    return laid.select("node", "depth", "conversations", "segment", "part", "offset", "size",
                       "position", "loss_from", "loss_to", "ancestors")


SPANS = "array<struct<part:int,from:bigint,to:bigint>>"
PLACES = f"node string, size long, part int, offset long, lent int, position long, spans {SPANS}"


def _joined(spans: Column, x: Column) -> Column:
    """``spans`` with one more, as part of the last one if it follows on it."""
    last = F.get(spans, F.size(spans) - 1)
    follows = (last["part"] == x["part"]) & (last["to"] == x["from"])
    longer = F.struct(last["part"].alias("part"), last["from"].alias("from"), x["to"].alias("to"))
    return F.when(F.coalesce(follows, F.lit(False)), F.concat(
        F.slice(spans, F.lit(1), F.size(spans) - 1), F.array(longer))).otherwise(
        F.concat(spans, F.array(x)))


def _lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of a part's nodes, which come depth first.

    ``lent``: how many turns of the path above lie in earlier parts; ``spans`` and
    ``position`` cover the others."""
    from pyspark import TaskContext
    part, at, path, lent = TaskContext.get().partitionId(), 0, None, 0
    span = pa.struct([("part", pa.int32()), ("from", pa.int64()), ("to", pa.int64())])
    for batch in batches:
        offsets, lents, positions, above = [], [], [], []
        for size, depth in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if path is None:
                path, lent = [((), 0)] * (depth - 1), depth - 1
            del path[depth - 1:]
            lent = min(lent, depth - 1)
            spans, position = path[-1] if path else ((), 0)
            offsets.append(at)
            lents.append(lent)
            positions.append(position)
            above.append([{"part": part, "from": a, "to": b} for a, b in spans])
            if spans and spans[-1][1] == at:
                spans = (*spans[:-1], (spans[-1][0], at + size))
            else:
                spans = (*spans, (at, at + size))
            path.append((spans, position + size))
            at += size
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([part] * n, pa.int32()),
             pa.array(offsets, pa.int64()), pa.array(lents, pa.int32()),
             pa.array(positions, pa.int64()), pa.array(above, pa.list_(span))],
            names=["node", "size", "part", "offset", "lent", "position", "spans"])


def read_back(paths_: DataFrame, nodes: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text), loss_text, attended, from the stored nodes alone.

    The conversation gives the path; text, turns and loss come out of the nodes, in the order
    of their position ids. ``attended``: code points in the intervals that the last node
    attends to, its own among them.
    """
    steps = paths_.select("conv_id", F.explode("path").alias("node"))
    attended = F.aggregate("ancestors", F.col("size"), lambda n, a: n + a["to"] - a["from"])
    parts = steps.join(nodes.select("node", "position", "segment", "loss_from", "loss_to",
                                    attended.alias("attended")), "node") \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
            "position", "segment", "loss_from", "loss_to", "attended"))).alias("parts"))

    def parsed(x: Column) -> Column:
        s = x["segment"]
        role = F.regexp_extract(s, r"(?s)^<s>\[([^\]]*)\]", 1)
        text = F.regexp_extract(s, r"(?s)^<s>\[[^\]]*\](.*)</s>$", 1)
        loss = F.when(x["loss_from"].isNotNull(), F.substring(
            s, x["loss_from"] + 1, x["loss_to"] - x["loss_from"]))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"),
                        F.coalesce(unescape(loss), F.lit("")).alias("loss"))

    return parts.select(
        "conv_id", F.array_join(F.transform("parts", lambda x: x["segment"]), "").alias("formatted"),
        F.transform("parts", parsed).alias("turns"),
        F.element_at("parts", -1)["attended"].alias("attended")) \
        .withColumn("loss_text", F.array_join(F.transform("turns", lambda t: t["loss"]), ""))


def format_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(paths, nodes) of conversations given one row a turn."""
    found = written(paths(turns), "chat-paths")
    return found, tree(found)


def digests(read: DataFrame) -> DataFrame:
    """Per conversation: counts and digests of what ``read_back`` found."""
    joined = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("attended").alias("attended_chars"))
