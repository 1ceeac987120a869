"""Reply trees as training conversations.

Messages name their parent. Paths from a root to each leaf are found by iterative self-joins that double the
distance: table k gives every message that has one its 2**k-th ancestor and the sum of scores up to it, made by
joining table k - 1 with itself, so a tree of depth d takes log2(d) joins. The leaves of a tree are ranked by the score
of their path, ties by the smaller leaf; the best ``branches`` are kept. Joining a kept leaf with the tables
from the largest distance down lists every message of its path once. Each path becomes one text.

The template (fixed): a system turn is ``<<SYS>>``text``<</SYS>>``, a user turn ``[INST] ``text`` [/INST]``, an
assistant turn ``<s>``text``</s>``, any other role ``[ROLE:``hex of its UTF-8``] ``text`` [/ROLE]``, a null role
the same without ``:`` and hex. Inside texts a backslash is doubled, and a backslash is put after the first
character of every control string, so no text holds one and reading back undoes it exactly. The loss mask
lists the stretches of assistant text, in code points.

Edge cases: a null text is an empty turn; a message whose parent is missing is a root; rows that repeat a tree
and message id count once (the one with the smallest parent, role and text); messages on a cycle of parents
have no root and are left out; a null tree id is a tree like any other; an empty table gives no conversation.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise

# Control strings, by the character a backslash is put after and what follows it.
CONTROL = r"<(/?s>|</?SYS>>)|\[(/?INST\]|/?ROLE)"


def escape(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    angled = F.regexp_replace(doubled, r"<(/?s>|</?SYS>>)", r"<\\$1")
    return F.regexp_replace(angled, r"\[(/?INST\]|/?ROLE)", r"[\\$1")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _marks(role: Column) -> tuple[Column, Column]:
    other = F.concat(F.lit("[ROLE"), F.coalesce(F.concat(F.lit(":"), F.hex(role.cast("binary"))), F.lit("")), F.lit("] "))
    opened = F.when(role == "system", "<<SYS>>").when(role == "user", "[INST] ").when(role == "assistant", "<s>").otherwise(other)
    closed = (
        F.when(role == "system", "<</SYS>>").when(role == "user", " [/INST]").when(role == "assistant", "</s>").otherwise(" [/ROLE]")
    )
    return opened, closed


def best_paths(messages: DataFrame, *, branches: int | None = 1) -> DataFrame:
    """(tree, leaf, node, back): the messages of each chosen path, ``back`` steps before its leaf.

    ``messages`` has tree, node, parent and score.
    """
    nodes = materialise(messages.groupBy("tree", "node").agg(F.min(F.struct("parent", "score")).alias("m")).select(
        "tree", "node", F.col("m.parent").alias("parent"), F.coalesce("m.score", F.lit(0.0)).alias("score")
    ), "nodes")

    def other(names: str) -> DataFrame:
        return nodes.select(*(F.col(a).alias(b) for a, b in (p.split("=") for p in names.split())))

    # A parent that is no message of the tree is none.
    known = other("tree=t node=p")
    first = materialise(nodes.join(known, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("p")), "left").select(
        "tree", "node", F.col("p").alias("up"), F.col("score").alias("sum")
    ), "up")
    # Scores summed from a message to its root, and from the others to the ancestor that was reached.
    totals = first.where("up is null").select("tree", "node", "sum")
    tables = [first.where("up is not null")]
    limit = max(1, nodes.count()).bit_length() + 1
    while not tables[-1].isEmpty() and len(tables) <= limit:
        here = tables[-1]
        far = here.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("far"), F.col("sum").alias("more"))
        step = materialise(here.join(far, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n")), "left").drop("t", "n"), "up")
        above = totals.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("sum").alias("rest"))
        ended = step.where("far is null").join(above, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n")))
        totals = totals.union(materialise(ended.select("tree", "node", (F.col("sum") + F.col("rest")).alias("sum")), "totals"))
        # Only messages with an ancestor still farther away go on.
        tables.append(step.where("far is not null").select("tree", "node", F.col("far").alias("up"), (F.col("sum") + F.col("more")).alias("sum")))
    parents = tables[0].select(F.col("tree").alias("t"), F.col("up").alias("n")).distinct()
    # What never came to a root is on a cycle or hangs off one.
    leaves = totals.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_anti")
    if branches is not None:
        ranked = Window.partitionBy("tree").orderBy(F.desc("sum"), "node")
        leaves = leaves.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= branches)
    path = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back"))
    for k in range(len(tables) - 2, -1, -1):
        hop = tables[k].select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        path = materialise(path, "path")
        further = path.join(hop, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("back") + (1 << k)).alias("back")
        )
        path = path.union(further)
    return path


def format_trees(messages: DataFrame, *, branches: int | None = 1) -> DataFrame:
    """(tree, leaf, n_turns, formatted, loss): one text per chosen path of a reply tree.

    ``messages`` has tree, node, parent, score, role and text.
    """
    paths = best_paths(messages.select("tree", "node", "parent", "score"), branches=branches)
    opened, closed = _marks(F.col("role"))
    body = messages.groupBy("tree", "node").agg(F.min(F.struct("parent", "score", "role", "text")).alias("m")).select(
        F.col("tree").alias("t"), F.col("node").alias("n"), F.col("m.role").alias("role"), escape(F.col("m.text")).alias("text")
    ).select("t", "n", opened.alias("open"), "text", closed.alias("close"), F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("learn"))
    turns = paths.join(body, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
    piece = F.concat("open", "text", "close")
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("back"))
    start = F.coalesce(F.sum(F.length(piece)).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("open")
    turns = turns.select(
        "tree", "leaf", (-F.col("back")).alias("at"), piece.alias("piece"),
        F.when(F.col("learn"), F.struct(start.alias("start"), (start + F.length("text")).alias("end"))).alias("loss"),
    )
    whole = turns.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(F.struct("at", "piece", "loss"))).alias("turns"))
    return whole.select(
        "tree", "leaf", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.filter(F.col("turns.loss"), lambda s: s.isNotNull()).alias("loss"),
    )


_TURN = re.compile(
    r"<<SYS>>(?P<system>.*?)<</SYS>>|\[INST\] (?P<user>.*?) \[/INST\]|<s>(?P<assistant>.*?)</s>"
    r"|\[ROLE(?P<role>:[0-9A-F]*)?\] (?P<other>.*?) \[/ROLE\]",
    re.S,
)


def parse(formatted: str) -> list[tuple[str | None, str]]:
    """(role, text) of every turn; a text that is no conversation raises."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        kind = found.lastgroup
        name = None if found["role"] is None else bytes.fromhex(found["role"][1:]).decode()
        turns.append((name if kind == "other" else kind, unescape(found[kind])))
        at = found.end()
    return turns


def masked_text(formatted: str, loss) -> str:
    return "".join(unescape(formatted[a:b]) for a, b in loss)


def read_back(formatted: DataFrame) -> DataFrame:
    """tree, n_turns and digests, from nothing but the formatted texts and their loss masks."""
    kind = formatted.schema["tree"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = []
            for tree, text, loss in zip(batch["tree"], batch["formatted"], batch["loss"]):
                turns = parse(text)
                learnt = masked_text(text, [(s["start"], s["end"]) for s in loss])
                whole = "".join(f"{role or ''}\n{said}\n" for role, said in turns)
                rows.append((
                    tree, len(turns), hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest(), len(learnt),
                    hashlib.sha256(learnt.encode("utf-8", "surrogatepass")).hexdigest(), len(text),
                ))
            if rows:
                yield pd.DataFrame(rows, columns=["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("tree", "formatted", "loss").mapInPandas(
        run, f"tree {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
