"""Pointers, trees and small directed graphs, by joins whose number grows with the logarithm of the
depth (pointers) or with the depth (trees), never by walking on the driver."""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.session import written


def chase(edges: DataFrame, node: str, pointer: str, rounds: int = 24) -> DataFrame:
    """``node, root, status`` of each node of a pointer table (null pointer: a root).

    Every round doubles the length of what is followed. ``status``: ``root``, ``found``, ``missing``
    (the chain leaves the table; ``root`` is then null) or ``cycle``. Duplicate rows of a node count
    by their smallest pointer.
    """
    nodes = edges.groupBy(F.col(node).alias("id")).agg(F.min(pointer).alias("p"))
    t = nodes.select(F.col("id").alias("t_id"), F.col("p").alias("t_p"))
    # at: where the chain has come to; done: it is a root; lost: it is no node
    state = nodes.join(t, F.col("p") == F.col("t_id"), "left").select(
        "id",
        F.coalesce("p", "id").alias("at"),
        (F.col("p").isNull() | (F.col("t_id").isNotNull() & F.col("t_p").isNull())).alias("done"),
        (F.col("p").isNotNull() & F.col("t_id").isNull()).alias("lost"),
        F.col("p").isNull().alias("is_root"),
    )
    state = written(state, "pointers")
    open_before = -1
    for _ in range(rounds):
        n_open = state.where("not done and not lost").count()
        if n_open == 0 or n_open == open_before:
            break
        open_before = n_open
        j = state.select(F.col("id").alias("j_id"), F.col("at").alias("j_at"), F.col("done").alias("j_done"), F.col("lost").alias("j_lost"))
        step = state.join(j, (F.col("at") == F.col("j_id")) & ~F.col("done") & ~F.col("lost"), "left")
        state = written(
            step.select("id", F.coalesce("j_at", "at").alias("at"), F.coalesce("j_done", "done").alias("done"), F.coalesce("j_lost", "lost").alias("lost"), "is_root"),
            "pointers",
        )
    status = F.when(F.col("is_root"), "root").when(F.col("done"), "found").when(F.col("lost"), "missing").otherwise("cycle")
    return state.select(F.col("id").alias(node), F.when(F.col("done"), F.col("at")).alias("root"), status.alias("status"))


def chase_bounded(edges: DataFrame, node: str, pointer: str, hops: int = 5) -> DataFrame:
    """``node, reached``: whether a root is reached within so many hops."""
    t = edges.groupBy(F.col(node).alias("t_id")).agg(F.min(pointer).alias("t_p"))
    state = t.select(F.col("t_id").alias(node), F.col("t_id").alias("at"), F.lit(True).alias("known"), F.col("t_p").alias("next"))
    for n in range(hops):
        j = t.select(F.col("t_id").alias(f"j{n}"), F.col("t_p").alias(f"p{n}"))
        step = state.join(j, F.col("next") == F.col(f"j{n}"), "left")
        moved = F.col("next").isNotNull()
        state = step.select(node, F.coalesce("next", "at").alias("at"), F.when(moved, F.col(f"j{n}").isNotNull()).otherwise(F.col("known")).alias("known"), F.when(moved, F.col(f"p{n}")).alias("next"))
    return state.select(node, (F.col("known") & F.col("next").isNull()).alias("reached"))


def single_root(chased: DataFrame, sources: DataFrame, node: str, source: str) -> DataFrame:
    """``source, root, ambiguous``: the root of each source's nodes; ambiguous if they have several."""
    j = chased.join(sources.select(node, source), node).where("root is not null")
    return j.groupBy(source).agg(F.min("root").alias("root"), (F.min("root") != F.max("root")).alias("ambiguous"))


def tree(rows: DataFrame, node: str, parent: str, label: str) -> DataFrame:
    """``node, depth, path, place`` in pre-order: children of a node by label.

    A node whose parent is null or not in the table is a root. Nodes on cycles, which no root
    reaches, are left out. One join a level; it stops at the first empty one.
    """
    t = rows.groupBy(F.col(node).alias("n")).agg(F.min(parent).alias("p"), F.min(label).alias("l"))
    known = t.select(F.col("n").alias("k"))
    sibling = F.row_number().over(Window.partitionBy("p2").orderBy("l", "n"))
    marked = t.join(known, F.col("p") == F.col("k"), "left").withColumn("p2", F.when(F.col("k").isNotNull(), F.col("p"))).withColumn("s", F.lpad(sibling.cast("string"), 10, "0"))
    marked = written(marked.select("n", "p2", "l", "s"), "tree")
    level = marked.where("p2 is null").select("n", F.lit(0).alias("depth"), F.col("l").alias("path"), F.col("s").alias("key"))
    out = level = written(level, "level")
    for d in itertools.count(1):  # cycles are never reached, so a level is empty in the end
        up = level.select(F.col("n").alias("u"), F.col("path").alias("u_path"), F.col("key").alias("u_key"))
        level = marked.join(up, F.col("p2") == F.col("u")).select("n", F.lit(d).alias("depth"), F.concat("u_path", F.lit(" / "), "l").alias("path"), F.concat("u_key", F.lit("."), "s").alias("key"))
        level = written(level, "level")
        if level.isEmpty():
            break
        out = out.unionByName(level)
    from stemma.operators.ordered import numbered

    return numbered(out, ["key"], "place").select(F.col("n").alias(node), "depth", "path", "place")


def walked(rows: DataFrame, node: str, parent: str, label: str, kinds: Column) -> DataFrame:
    """``tree`` of the nodes of some kinds only: a node of another kind is passed by with all below it.

    A node whose parent is of another kind is no root, unless the parent is not in the table at all.
    """
    kept = rows.where(F.coalesce(kinds, F.lit(False)))
    gone = rows.where(~F.coalesce(kinds, F.lit(False))).select(F.col(node).alias("_gone")).distinct()
    # below what was passed by: a parent that is no node, and no root either
    cut = kept.join(gone, F.col(parent) == F.col("_gone"), "left")
    return tree(cut.withColumn(parent, F.when(F.col("_gone").isNotNull(), F.col(node)).otherwise(F.col(parent))).drop("_gone"), node, parent, label)


def traced(links: DataFrame, starts: DataFrame, passing: Column, most: int = 8) -> DataFrame:
    """``start, target, hops``: the node each start leads to when pass-through nodes are followed.

    ``links``: ``node, source, kind`` (kind of the source node); ``starts``: ``start`` (a node).
    ``passing`` is a condition on ``kind``. Chains longer than ``most``, and cycles, end where they are.
    """
    j = links.groupBy("node").agg(F.min_by("source", "source").alias("source"), F.min_by("kind", "source").alias("kind"))
    state = starts.join(j, F.col("start") == F.col("node")).select("start", F.col("source").alias("at"), F.lit(1).alias("hops"), passing.alias("go"))
    for _ in range(most - 1):
        step = j.select(F.col("node").alias("j_node"), F.col("source").alias("j_source"), passing.alias("j_go"))
        nxt = state.join(step, (F.col("at") == F.col("j_node")) & F.col("go"), "left")
        state = nxt.select("start", F.coalesce("j_source", "at").alias("at"), (F.col("hops") + F.col("j_source").isNotNull().cast("int")).alias("hops"), F.coalesce("j_go", F.lit(False)).alias("go"))
    return state.select("start", F.col("at").alias("target"), "hops")


def upstream_roles(users: DataFrame, nodes: DataFrame, passing: Column, wanted: Column, most: int = 8) -> DataFrame:
    """``user, role, target``: the node that an input (``user, role, at``) comes from when pass-through nodes are followed.

    ``nodes``: ``node, kind, source`` (null source: none); ``passing`` and ``wanted`` are conditions on
    ``kind``. Only targets of a wanted kind come out. Longer chains than ``most`` and cycles come to none.
    """
    n = nodes.groupBy("node").agg(F.min_by(F.struct("kind", "source"), F.struct("kind", "source")).alias("n")).select("node", "n.kind", "n.source")
    marked = n.select(F.col("node").alias("_n"), passing.alias("_pass"), wanted.alias("_want"), F.col("source").alias("_source"))
    state = users.select("user", "role", "at", F.lit(None).cast("boolean").alias("done"))
    for _ in range(most + 1):
        step = state.join(marked, (F.col("at") == F.col("_n")) & F.col("done").isNull(), "left")
        on = F.coalesce(F.col("_pass") & F.col("_source").isNotNull(), F.lit(False))
        state = step.select("user", "role", F.when(on, F.col("_source")).otherwise(F.col("at")).alias("at"), F.coalesce("done", F.when(~on, F.coalesce("_want", F.lit(False)))).alias("done"))
    return state.where("done").select("user", "role", F.col("at").alias("target"))


def unique_names(rows: DataFrame, name: str, node: str) -> DataFrame:
    """``rows`` with ``unique_name``: where several rows share a name, all of them get ``_node``."""
    n = F.count(F.lit(1)).over(Window.partitionBy(name))
    return rows.withColumn("unique_name", F.when(n > 1, F.concat(F.col(name), F.lit("_"), F.col(node).cast("string"))).otherwise(F.col(name)))


def wiki_report(pages: DataFrame, stale_before: str, long: int = 200, index: DataFrame | None = None, tags: list[str] | None = None, hashes: DataFrame | None = None) -> DataFrame:
    """``page, issue, detail`` of a set of linked pages (``page, text, updated``).

    ``broken_link`` (to no page), ``orphan`` (no other page links to it), ``stale`` (not updated
    since), ``long`` (more than so many lines). With an ``index`` (``page``): ``not_indexed`` and
    ``indexed_only`` (no such page). With the ``tags`` that are allowed: ``unknown_tag``. With recorded
    ``hashes`` (``page, sha256``): ``changed`` (the text's hash is another now).
    """
    from stemma.functions.text import links

    edges = pages.select("page", F.explode(links("text")).alias("to")).distinct()
    known = pages.select(F.col("page").alias("to"))
    none = F.lit(None).cast("string")
    found = [edges.join(known, "to", "left_anti").select("page", F.lit("broken_link").alias("issue"), F.col("to").alias("detail"))]
    linked = edges.where("page <> to").select(F.col("to").alias("page")).distinct()
    found.append(pages.join(linked, "page", "left_anti").select("page", F.lit("orphan").alias("issue"), none.alias("detail")))
    found.append(pages.where(F.col("updated") < F.lit(stale_before).cast("date")).select("page", F.lit("stale").alias("issue"), F.col("updated").cast("string").alias("detail")))
    lines = F.size(F.split("text", "\n"))
    found.append(pages.where(lines > long).select("page", F.lit("long").alias("issue"), lines.cast("string").alias("detail")))
    if index is not None:
        own = index.select("page").distinct()
        found.append(pages.join(own, "page", "left_anti").select("page", F.lit("not_indexed").alias("issue"), none.alias("detail")))
        found.append(own.join(pages, "page", "left_anti").select("page", F.lit("indexed_only").alias("issue"), none.alias("detail")))
    if tags is not None:
        used = pages.select("page", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?:^|\s)#([A-Za-z][\w-]*)"), F.lit(1)))).alias("tag"))
        found.append(used.where(~F.col("tag").isin(*tags)).select("page", F.lit("unknown_tag").alias("issue"), F.col("tag").alias("detail")))
    if hashes is not None:
        now = pages.select("page", F.sha2("text", 256).alias("now"))
        found.append(now.join(hashes.select("page", "sha256"), "page").where("now <> sha256").select("page", F.lit("changed").alias("issue"), F.col("now").alias("detail")))
    return reduce(DataFrame.unionByName, found)
