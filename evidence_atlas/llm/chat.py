"""Conversations from reply trees, with a reversible template and a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ensure_checkpoint_dir

#: Fixed values of the template. A turn is OPEN role NEWLINE text CLOSE; CLOSE
#: ends in a newline. Control strings all begin with < or [.
OPEN, CLOSE = "<|turn|>", "<|end|>\n"

#: Inside roles and texts a backslash is doubled and what starts a control
#: string becomes a backslash and a letter, so none can arise there.
_SIGNS = {"<": "l", "[": "s"}


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for sign, letter in _SIGNS.items():
        out = F.replace(out, F.lit(sign), F.lit("\\" + letter))
    return out


def unescaped(text: Column) -> Column:
    out = text
    for sign, letter in _SIGNS.items():
        # a doubled backslash is a backslash: only one after an even number of others escapes the letter
        out = F.regexp_replace(out, r"(?<!\\)((?:\\\\)*)\\" + letter, "$1" + sign)
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def best_paths(nodes: DataFrame, tree: str = "tree_id", node: str = "node_id", parent: str = "parent_id", score: str = "score", keep: int = 1) -> DataFrame:
    """(tree, branch, rise, node): the nodes, rise steps above their leaf, of the ``keep`` best root-to-leaf paths of each tree.

    A path's score is the sum of its nodes' scores (null counts as 0); ties go
    to the smaller leaf. Self-joins double the reach of every node's pointer
    until all pointers have met a root: round k knows the ancestor 2^k steps
    up and the score so far, so a tree of depth d takes log2(d) joins. The
    chosen leaves then walk back up the same pointers, from the farthest to
    the nearest. A parent that is missing, or null, makes its node a root.
    Every round is checkpointed in the shared folder. Node ids must be unique
    in their tree; nodes on a cycle belong to no root and are left out.
    """
    ensure_checkpoint_dir(nodes.sparkSession)
    base = nodes.select(F.col(tree).alias("t"), F.col(node).alias("n"), F.col(parent).alias("p"), F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("s"))
    known = base.select("t", F.col("n").alias("p"), F.lit(True).alias("there"))
    base = base.join(known, ["t", "p"], "left").select("t", "n", F.when(F.col("there"), F.col("p")).alias("up"), "s").checkpoint()
    levels = [base]
    most = base.count()
    while True:
        now = levels[-1]
        if now.where("up is not null").isEmpty() or 2 ** len(levels) > 2 * most:
            break
        far = now.select("t", F.col("n").alias("up"), F.col("up").alias("farther"), F.col("s").alias("more"))
        on = now.where("up is not null")  # who has met a root is done
        step = on.join(far, ["t", "up"], "left").select("t", "n", F.when(F.col("up").isNotNull(), F.col("farther")).alias("up"), (F.col("s") + F.coalesce("more", F.lit(0.0))).alias("s"))
        levels.append(step.unionByName(now.where("up is null")).checkpoint())
    inner = base.where("up is not null").select("t", F.col("up").alias("n")).distinct()
    leaves = levels[-1].where("up is null").join(inner, ["t", "n"], "left_anti")
    rank = Window.partitionBy("t").orderBy(F.desc("s"), F.asc("n"))
    chosen = leaves.withColumn("branch", F.row_number().over(rank)).where(F.col("branch") <= keep)
    walk = chosen.select("t", "branch", "n", F.lit(0).cast("long").alias("rise"))
    for k in reversed(range(len(levels))):
        jump = levels[k].where("up is not null").select("t", "n", "up")
        here, above = F.struct("n", "rise"), F.struct(F.col("up").alias("n"), (F.col("rise") + 2**k).alias("rise"))
        both = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, above))
        walk = walk.join(jump, ["t", "n"], "left").select("t", "branch", F.explode(both).alias("x")).select("t", "branch", "x.*")
    return walk.select(F.col("t").alias(tree), "branch", "rise", F.col("n").alias(node))


def format_conversations(paths: DataFrame, conversation: list[str], order: str = "ord", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: its keys, formatted text and loss_spans.

    loss_spans is array<struct<start, end>> (code points of the formatted
    text, end exclusive): the text of each assistant turn as it is written
    there, without role and control strings. Null roles and texts are empty.
    """
    turn = F.struct(
        F.col(order).alias("ord"),
        F.concat(F.lit(OPEN), _escaped_role(F.coalesce(role, F.lit(""))), F.lit("\n")).alias("head"),
        escaped(F.coalesce(text, F.lit(""))).alias("body"),
        (F.coalesce(role, F.lit("")) == "assistant").alias("loss"),
    )
    out = paths.groupBy(*conversation).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    kind = "struct<at:int,out:array<struct<start:int,end:int>>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out")).cast(kind)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["head"])
        end = start + F.length(x["body"])
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.struct((end + len(CLOSE)).alias("at"), F.when(x["loss"], F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out")).cast(kind)

    written = F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "")
    return out.select(*conversation, written.alias("formatted"), F.aggregate("turns", zero, step, lambda acc: acc["out"]).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The columns of ``formatted`` plus turns, array<struct<role, text>>, parsed from the text alone."""
    cut = F.split("formatted", r"<\|turn\|>", -1)
    parts = F.slice(cut, F.lit(2), F.size(cut))

    def turn(x: Column) -> Column:
        head = F.substring_index(x, "\n", 1)
        rest = F.substring(x, F.length(head) + 2, F.length(x) - F.length(head) - 1 - len(CLOSE))
        return F.struct(_unescaped_role(head).alias("role"), unescaped(rest).alias("text"))

    return formatted.withColumn("turns", F.transform(parts, turn))


def reply_chain(conversations: DataFrame) -> DataFrame:
    """Reply trees of a turn table: the parent of a row is the row before it.

    Rows go by turn (nulls last), then role and text, so that repeated turns
    are all kept in a defined order.
    """
    w = Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("turn"), F.asc_nulls_last("role"), F.asc_nulls_last("text"))
    at = conversations.select("conv_id", "role", "text", F.row_number().over(w).cast("long").alias("node_id"))
    return at.withColumn("parent_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1)).withColumn("score", F.lit(1.0))


def format_best_branches(nodes: DataFrame, tree: str = "tree_id", keep: int = 1) -> DataFrame:
    """Format the ``keep`` best branches of every reply tree.

    ``nodes`` has the tree's id, node_id, parent_id, score, role and text.
    Trees with a null id are formatted as one tree of their own. Returns the
    tree's id, branch, formatted and loss_spans; an empty table gives none.
    """
    keyed = nodes.withColumn("_tree", F.coalesce(F.col(tree).cast("string"), F.lit("")))
    paths = best_paths(keyed, tree="_tree", keep=keep)
    turns = paths.join(keyed.select("_tree", tree, "node_id", "role", "text"), ["_tree", "node_id"]).withColumn("ord", -F.col("rise"))
    return format_conversations(turns, ["_tree", tree, "branch"]).drop("_tree")


def op6_chat(spark, sf_dir):
    """Every conversation, and conversation -7, formatted and read back from the output."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    nodes = reply_chain(rows.unionByName(extra))
    out = read_back(format_best_branches(nodes, "conv_id"))
    plain = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    masked = F.array_join(F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "")
    return out.select("conv_id", "turns", "formatted", plain.alias("plain"), masked.alias("loss")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2("plain", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP6_SQL = r"""
with c as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), r as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls last, role nulls last, text nulls last) as k,
         coalesce(role, '') as role, coalesce(text, '') as text
  from c
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
  coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by k), '')) as loss_sha256,
  sum(8 + 1 + 8
      + 2 * length(role) + length(regexp_replace(role, '[^\\<\[]', '', 'g')) - length(replace(role, chr(10), ''))
      + length(text) + length(regexp_replace(text, '[^\\<\[]', '', 'g')))::bigint as formatted_chars
from r group by conv_id
"""
