"""Chat formatting: choose root-to-leaf paths of reply trees and write each as one conversation."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from judgeset.llm._tables import Scratch, table


@dataclass(frozen=True)
class Template:
    """<|turn|>role, newline, text, <|end|>. Control strings inside texts get a backslash after their first character.

    Backslashes are doubled first, so one lone backslash after such a first character occurs only where it was put in.
    """

    turn: str = "<|turn|>"
    end: str = "<|end|>"
    loss_role: str = "assistant"
    controls: tuple[str, ...] = ("<|", "</s>", "<s>", "[INST]", "[/INST]")

    def escape(self, c: Column) -> Column:
        out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
        return reduce(lambda x, s: F.replace(x, F.lit(s), F.lit(s[0] + "\\" + s[1:])), self.controls, out)

    def unescape(self, c: Column) -> Column:
        out = reduce(lambda x, s: F.replace(x, F.lit(s[0] + "\\" + s[1:]), F.lit(s)), self.controls[::-1], c)
        return F.replace(out, F.lit("\\\\"), F.lit("\\"))

    def escape_role(self, c: Column) -> Column:
        """A role ends at the first newline, so its own newlines are written <\\n>."""
        return F.replace(self.escape(c), F.lit("\n"), F.lit("<\\n>"))

    def unescape_role(self, c: Column) -> Column:
        return self.unescape(F.replace(c, F.lit("<\\n>"), F.lit("\n")))


def format_reply_trees(
    messages: DataFrame,
    conv: str = "conv_id",
    node: str = "node_id",
    parent: str = "parent_id",
    role: str = "role",
    text: str = "text",
    score: str | None = None,
    top_k: int = 1,
    template: Template = Template(),
) -> DataFrame:
    """The top_k best root-to-leaf paths of every conversation, each as one formatted conversation.

    messages has a row per message; parent is a node of the same conversation. A message is a root if its parent is
    null, missing from the conversation, or itself. A path's score is the mean of its messages' scores (null: 0); ties
    go to the smaller leaf node. Paths are found by pointer doubling: each round joins the pointers with themselves,
    so a tree of depth d takes log2(d) self-joins, and only chosen paths are written out in full.

    Returns conv, leaf, path_rank (from 1), path_score, n_turns, formatted, segments (array of text and loss, whose
    texts concatenate to formatted) and loss_spans (start and length in code points of what a trainer's loss covers).
    Null texts and roles count as empty. Of rows that repeat a node the one with the smallest role, text and score
    stays. Null conversations and nodes are keys like any other. Messages on a cycle of parents have no root and give
    no path. Other columns of messages are ignored. An empty table gives no rows.
    """
    spark = messages.sparkSession
    scratch = Scratch(spark, "chat")
    value = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    own = messages.select(
        F.struct(F.col(conv).alias("c"), F.col(node).alias("n")).alias("key"),
        F.when(F.col(parent).isNotNull() & ~F.col(parent).eqNullSafe(F.col(node)), F.struct(F.col(conv).alias("c"), F.col(parent).alias("n"))).alias("up"),
        F.struct(F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"), value.alias("score")).alias("msg"),
    )
    nodes = scratch.keep(own.groupBy("key").agg(F.min(F.struct("msg", "up")).alias("m")).select("key", "m.msg", "m.up"), "nodes")

    there = nodes.select(F.col("key").alias("up"), F.lit(True).alias("known"))
    rooted = nodes.select("key", "up", F.col("msg.score").alias("total")).join(there, "up", "left")
    # One row per node and round: the ancestor 2^k up, and what lies between. Nodes that reach their root leave the loop.
    step = scratch.keep(rooted.select("key", F.when(F.col("known"), F.col("up")).alias("ptr"), "total", F.lit(1).cast("long").alias("depth")), "round")
    done = [step.filter(F.col("ptr").isNull())]
    jumps, left, rounds = [], step.filter(F.col("ptr").isNotNull()), 0
    most = max(1, nodes.count()).bit_length()
    finished = step.filter(F.col("ptr").isNull()).select(F.col("key").alias("ptr"), F.lit(None).cast(nodes.schema["key"].dataType).alias("next"), F.col("total").alias("more"), F.col("depth").alias("far"))
    while not left.isEmpty() and rounds <= most:
        jumps.append(left.select("key", "ptr"))
        ahead = left.select(F.col("key").alias("ptr"), F.col("ptr").alias("next"), F.col("total").alias("more"), F.col("depth").alias("far")).unionByName(finished)
        step = scratch.keep(left.join(ahead, "ptr").select("key", F.col("next").alias("ptr"), (F.col("total") + F.col("more")).alias("total"), (F.col("depth") + F.col("far")).alias("depth")), "round")
        reached = step.filter(F.col("ptr").isNull())
        done.append(reached)
        finished = finished.unionByName(reached.select(F.col("key").alias("ptr"), F.lit(None).cast(nodes.schema["key"].dataType).alias("next"), F.col("total").alias("more"), F.col("depth").alias("far")))
        left, rounds = step.filter(F.col("ptr").isNotNull()), rounds + 1

    all_done = reduce(DataFrame.unionByName, done)
    inner = nodes.filter(F.col("up").isNotNull()).select(F.col("up").alias("key"))
    leaves = all_done.join(inner, "key", "left_anti").select(F.col("key.c").alias("c"), F.col("key").alias("leaf"), "depth", (F.col("total") / F.col("depth")).alias("path_score"))
    ranked = leaves.withColumn("path_rank", F.row_number().over(W.partitionBy("c").orderBy(F.desc("path_score"), F.col("leaf"))))
    path = ranked.filter(F.col("path_rank") <= top_k).select("leaf", "path_rank", "path_score", "depth", F.col("leaf").alias("key"), F.lit(0).cast("long").alias("back"))
    for k, jump in reversed(list(enumerate(jumps))):  # every distance from the leaf is one sum of falling powers of two
        both = F.array(F.struct("key", "back"), F.when(F.col("ptr").isNotNull(), F.struct(F.col("ptr").alias("key"), (F.col("back") + 2**k).alias("back"))))
        path = path.join(jump, "key", "left").select("leaf", "path_rank", "path_score", "depth", F.explode(F.filter(both, lambda x: x.isNotNull())).alias("x")).select("leaf", "path_rank", "path_score", "depth", "x.key", "x.back")

    head = F.concat(F.lit(template.turn), template.escape_role(F.col("msg.role")), F.lit("\n"))
    turns = path.join(nodes.select("key", "msg"), "key").select(
        "leaf", "path_rank", "path_score",
        (F.col("depth") - F.col("back")).alias("pos"), head.alias("head"), template.escape(F.col("msg.text")).alias("body"),
        (F.col("msg.role") == template.loss_role).alias("loss"),
    )
    order = W.partitionBy("leaf").orderBy("pos")
    size = F.char_length("head") + F.char_length("body") + len(template.end)
    turns = turns.withColumn("start", F.sum(size).over(order.rowsBetween(W.unboundedPreceding, -1)))
    turns = turns.withColumn("start", F.coalesce("start", F.lit(0)) + F.char_length("head"))
    got = turns.groupBy("leaf", "path_rank", "path_score").agg(F.sort_array(F.collect_list(F.struct("pos", "head", "body", "loss", "start"))).alias("t"))
    segments = F.flatten(F.transform("t", lambda x: F.array(F.struct(x.head.alias("text"), F.lit(False).alias("loss")), F.struct(x.body.alias("text"), x.loss.alias("loss")), F.struct(F.lit(template.end).alias("text"), F.lit(False).alias("loss")))))
    spans = F.transform(F.filter("t", lambda x: x.loss), lambda x: F.struct(x.start.alias("start"), F.char_length(x.body).cast("long").alias("length")))
    return got.select(
        F.col("leaf.c").alias(conv), F.col("leaf.n").alias("leaf"), "path_rank", "path_score", F.size("t").cast("long").alias("n_turns"),
        segments.alias("segments"), spans.alias("loss_spans"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda x: x.text), ""))


def read_back(formatted: DataFrame, conv: str = "conv_id", template: Template = Template()) -> DataFrame:
    """Digests of what a formatted conversation holds: its turns, parsed from the formatted string, and what the loss mask
    (loss_spans) covers of that string. Needs conv, formatted and loss_spans of format_reply_trees; null or no spans
    cover nothing, a conversation without a turn has none."""
    literal = "\\Q" + template.turn + "\\E"
    pieces = F.filter(F.split("formatted", literal, -1), lambda _, i: i > 0)
    body = F.transform(pieces, lambda p: F.substring_index(p, template.end, 1))

    def turn(b: Column) -> Column:
        role = F.substring_index(b, "\n", 1)
        return F.concat(template.unescape_role(role), F.lit("\n"), template.unescape(F.substr(b, F.char_length(role) + 2)), F.lit("\n"))

    said = F.array_join(F.transform(body, turn), "")
    learnt = F.array_join(F.transform("loss_spans", lambda s: template.unescape(F.substr("formatted", s.start.cast("int") + 1, s.length.cast("int")))), "")
    return formatted.select(conv, F.size(pieces).cast("long").alias("n_turns"), said.alias("said"), learnt.alias("learnt"), F.char_length("formatted").cast("long").alias("formatted_chars")).select(
        conv, "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.char_length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"), "formatted_chars"
    )


#: The extra conversation of the query: texts that look like another template's control strings.
_EXTRA = "</s>[INST] ok [/INST]"


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, as a tree in which each row replies to the row before, plus conversation -7."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_EXTRA).alias("text"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    nodes = rows.unionByName(extra).withColumn("node_id", F.row_number().over(order)).withColumn("parent_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1))
    return read_back(format_reply_trees(nodes))


def _esc(c: str, t: Template = Template()) -> str:
    out = f"replace({c}, '\\', '\\\\')"
    for s in t.controls:
        out = f"replace({out}, '{s}', '{s[0]}\\{s[1:]}')"
    return out


OP6_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r0, text AS t0 FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_EXTRA}', 'user', '{_EXTRA}'
  UNION ALL SELECT -7, 1, 'assistant', '{_EXTRA}', 'assistant', '{_EXTRA}'
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS loss_sha256,
  CAST(sum({len(Template().turn) + len(Template().end) + 1} + length(replace({_esc("role")}, chr(10), '<\\n>')) + length({_esc("text")})) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""
