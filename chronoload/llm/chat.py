r"""Chat formatting of reply trees: the best root-to-leaf paths of each tree, each written as one conversation.

A message names its parent. Self-joins double the reach of a table of jumps (1, 2, 4, … replies up, with the score and the
number of turns passed) until no jump is left, so a chain of a million turns takes twenty joins. Each leaf climbs to its root
over the jumps, longest first; leaves of a tree are ranked by the sum of the scores on their path (ties: the smaller leaf), and
the chosen paths are unfolded over the same jumps. Only ids and numbers take part in this. Texts meet their places once, are
dealt by path and part (``PART`` turns) and formatted there, so no task holds a conversation of unbounded length; parts are
joined only where a whole conversation is asked for. A table of turns becomes chains: rows are numbered in (conversation, turn)
order by a range-partitioned sort and each answers the one before it. Everything is a DataFrame function.

Template: ``### <role>: <text></turn>\n`` a turn. In texts ``\`` is written ``\b``, ``</turn>`` ``\t`` and ``### `` ``\h``, in
roles also ``:`` ``\c``; so a control string occurs only where the template puts it, and reading back is exact. The loss mask
is a list of (start, end) code points of the assistant's texts in a part.

Defined results: null texts and roles are empty; turns of one number follow role and then the digest of the text; repeated rows
are turns of their own, next to each other; null conversation ids are one conversation, null turns come first. In trees: a
message without an id takes no part, of rows that share an id the least (parent, score, role, text) counts, a parent that
is not there makes its reply a root, messages on a cycle or below one are on no path, a null score is 0. Empty tables give
empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoload.llm.common import table
from chronoload.llm.numbering import numbered
from chronoload.session import prepare, stage

HEAD, MIDDLE, TAIL = "### ", ": ", "</turn>\n"
#: Control string and what stands for it; the escape character itself first.
ESCAPES = (("\\", "\\b"), ("</turn>", "\\t"), ("### ", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
LEARNED = "assistant"
PART = 32


def escaped(text: Column, escapes: Sequence[tuple[str, str]] = ESCAPES) -> Column:
    for control, stand_in in escapes:
        text = F.replace(text, F.lit(control), F.lit(stand_in))
    return text


def unescaped(text: Column, escapes: Sequence[tuple[str, str]] = ESCAPES) -> Column:
    for control, stand_in in reversed(escapes):
        text = F.replace(text, F.lit(stand_in), F.lit(control))
    return text


def jumps(nodes: DataFrame) -> list[DataFrame]:
    """Tables ``node, up, score, size``: the ancestor 2^k replies up, scores and turns behind ``node`` up to it.

    ``nodes`` (``node, parent, score, size``) must be staged. On a cycle jumps never end, so the reach stops at the table's size.
    """
    above = nodes.select(F.col("node").alias("up"), "score", "size")
    out = [stage(nodes.select("node", F.col("parent").alias("up")).join(above, "up").select("node", "up", "score", "size"), "jumps")]
    count = nodes.count()
    while 1 << len(out) < count:
        near = out[-1]
        far = near.select(F.col("node").alias("up"), F.col("up").alias("_top"), F.col("score").alias("_more"), F.col("size").alias("_longer"))
        longer = near.join(far, "up").select(
            "node", F.col("_top").alias("up"), (F.col("score") + F.col("_more")).alias("score"), (F.col("size") + F.col("_longer")).alias("size"))
        longer = stage(longer, "jumps")
        if longer.isEmpty():
            break
        out.append(longer)
    return out


def chosen_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """``node, path, root, rank, start, length``: the messages of the ``branches`` best paths of each tree, staged.

    ``path`` is the leaf, ``start`` the number of turns before the node on its path, ``length`` those of the path.
    """
    levels = jumps(nodes)
    replied = levels[0].select(F.col("up").alias("node"))
    leaves = nodes.join(replied, "node", "left_anti").select(
        F.col("node").alias("path"), F.col("node").alias("at"), "score", F.col("size").alias("length"), F.col("size").alias("_own"))
    for level in reversed(levels):
        step = level.select(F.col("node").alias("at"), F.col("up").alias("_up"), F.col("score").alias("_score"), F.col("size").alias("_size"))
        leaves = leaves.join(step, "at", "left").select(
            "path", F.coalesce("_up", "at").alias("at"), (F.col("score") + F.coalesce("_score", F.lit(0.0))).alias("score"),
            (F.col("length") + F.coalesce("_size", F.lit(0))).alias("length"), "_own")
    rooted = leaves.join(levels[0].select(F.col("node").alias("at")), "at", "left_anti").withColumnRenamed("at", "root")
    best = Window.partitionBy("root").orderBy(F.desc("score"), "path")  # Spark keeps ``branches`` a root before it shuffles
    ranked = rooted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    columns = ["node", "path", "root", "rank", "start", "length"]
    on_path = stage(ranked.withColumn("node", F.col("path")).withColumn("start", F.col("length") - F.col("_own")).select(*columns), "paths")
    for level in reversed(levels):
        up = on_path.join(level.select("node", "up", "size"), "node").withColumn("start", F.col("start") - F.col("size"))
        up = up.drop("node", "size").withColumnRenamed("up", "node").select(*columns)
        on_path = stage(on_path.unionByName(up), "paths")
    return on_path


def _parts(placed: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows ``group, part, start, times, role, text`` to one formatted row per group and part."""
    turn = F.struct("start", "times", "role", "text")
    rows = placed.groupBy(*group, "part").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    shown = F.flatten(F.transform("_turns", lambda t: F.array_repeat(
        F.struct(
            F.concat(F.lit(HEAD), escaped(t["role"], ROLE_ESCAPES), F.lit(MIDDLE)).alias("head"),
            escaped(t["text"]).alias("body"), (t["role"] == LEARNED).alias("learned"),
        ), t["times"].cast("int"))))
    rows = rows.select(*group, "part", shown.alias("_turns"))
    size = F.transform("_turns", lambda t: F.char_length(t["head"]) + F.char_length(t["body"]) + len(TAIL))
    rows = rows.withColumn("_size", size)
    begin = F.transform("_size", lambda _, k: F.aggregate(F.slice("_size", 1, k), F.lit(0), lambda a, b: a + b))
    rows = rows.withColumn("_begin", begin)
    spans = F.transform(F.arrays_zip("_turns", "_begin"), lambda z: F.struct(
        z["_turns"]["learned"].alias("learned"),
        (z["_begin"] + F.char_length(z["_turns"]["head"])).alias("start"),
        (z["_begin"] + F.char_length(z["_turns"]["head"]) + F.char_length(z["_turns"]["body"])).alias("end")))
    loss = F.transform(F.filter(spans, lambda s: s["learned"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    text = F.array_join(F.transform("_turns", lambda t: F.concat(t["head"], t["body"], F.lit(TAIL))), "")
    return rows.select(*group, "part", text.alias("formatted"), loss.alias("loss"))


def _spread(rows: DataFrame) -> DataFrame:
    """A message said ``copies`` times from turn ``start`` on, as one row for each part that it reaches."""
    end = F.col("start") + F.col("copies")
    first, last = F.floor(F.col("start") / PART), F.floor((end - 1) / PART)
    rows = rows.withColumn("part", F.explode(F.sequence(first, last)))
    times = F.least(end, (F.col("part") + 1) * PART) - F.greatest(F.col("start"), F.col("part") * PART)
    return rows.withColumn("times", times)


def format_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``messages`` (``message_id, parent_id, role, text, score``) to parts of the best paths of each tree.

    Returns ``path, root, rank, n_turns, part, formatted, loss``.
    """
    prepare(messages.sparkSession)
    own = messages.where(F.col("message_id").isNotNull()).select(
        "message_id", "parent_id", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    row = F.struct("parent_id", "score", "role", "text")
    own = own.groupBy(F.col("message_id").alias("node")).agg(F.min(row).alias("_m")).select("node", "_m.*")
    nodes = own.select("node", F.col("parent_id").alias("parent"), "score", F.lit(1).cast("long").alias("size"))
    paths = chosen_paths(stage(nodes, "messages"), branches)
    placed = own.select("node", "role", "text").join(paths, "node").withColumn("part", F.floor(F.col("start") / PART))
    placed = placed.withColumnRenamed("length", "n_turns").withColumn("times", F.lit(1).cast("long"))
    return _parts(placed, ["path", "root", "rank", "n_turns"])


def format_conversations(turns: DataFrame) -> DataFrame:
    """``turns`` (``conv_id, turn, role, text``) to formatted parts: ``conv_id, n_turns, part, formatted, loss``."""
    prepare(turns.sparkSession)
    key = ["conv_id", "turn", "role", "_hash"]
    said = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("_hash", F.unhex(F.md5("text")))
    distinct = said.groupBy(*key).agg(F.count("*").alias("size"))
    order = [F.asc_nulls_first(c) for c in key]
    rows = stage(numbered(distinct, order, "node", "turns"), "turns")
    before = rows.select((F.col("node") + 1).alias("node"), F.col("conv_id").alias("_conv"), F.col("node").alias("_before"))
    parent = F.when(F.col("conv_id").eqNullSafe(F.col("_conv")), F.col("_before"))
    nodes = rows.select("node", "conv_id", "size").join(before, "node", "left")
    nodes = stage(nodes.select("node", parent.alias("parent"), F.lit(0.0).alias("score"), "size"), "replies")
    paths = chosen_paths(nodes)
    places = stage(paths.join(rows, "node").select(
        *[F.col(c).alias(f"_{c}") for c in key], "path", "start", F.col("length").alias("n_turns"), F.col("size").alias("copies")), "places")
    met = [said[c].eqNullSafe(places[f"_{c}"]) for c in key]
    placed = said.join(places, met).select("conv_id", "path", "n_turns", "start", "copies", "role", "text")
    once = placed.where("copies = 1").withColumn("part", F.floor(F.col("start") / PART)).withColumn("times", F.lit(1).cast("long"))
    often = _spread(placed.where("copies > 1").dropDuplicates(["path", "start"]))
    return _parts(once.unionByName(often), ["conv_id", "path", "n_turns"]).drop("path")


def read_back(parts: DataFrame) -> DataFrame:
    """``parts`` with ``turns`` (array of role and text) and ``learned`` (texts under the loss mask), read from the output."""
    pieces = F.split("formatted", TAIL, -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    body = F.transform(pieces, lambda p: F.substring(p, F.lit(len(HEAD) + 1), F.char_length(p)))

    def turn(b: Column) -> Column:
        role = F.substring_index(b, MIDDLE, 1)
        text = F.substring(b, F.char_length(role) + len(MIDDLE) + 1, F.char_length(b))
        return F.struct(unescaped(role, ROLE_ESCAPES).alias("role"), unescaped(text).alias("text"))

    learned = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return parts.withColumn("turns", F.transform(body, turn)).withColumn("learned", learned)


def whole_conversations(parts: DataFrame, group: Sequence[str]) -> DataFrame:
    """``group, formatted``: the parts of each conversation in order, as one text."""
    texts = parts.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("part", "formatted"))).alias("_p"))
    return texts.select(*group, F.array_join(F.col("_p.formatted"), "").alias("formatted"))


def digests(parts: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    A conversation of one part is digested where it is; only longer ones are dealt again.
    """
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = read_back(parts).select(
        "conv_id", "n_turns", "part", F.size("turns").cast("long").alias("_n"), told.alias("_told"),
        F.array_join("learned", "").alias("_learned"), F.char_length("formatted").cast("long").alias("_chars"))
    short = rows.where(F.col("n_turns") <= PART)
    texts = F.sort_array(F.collect_list(F.struct("part", "_told", "_learned")))
    long = rows.where(F.col("n_turns") > PART).groupBy("conv_id").agg(
        F.sum("_n").alias("_n"), F.sum("_chars").alias("_chars"), texts.alias("_p"))
    long = long.select("conv_id", "_n", "_chars", F.array_join(F.col("_p._told"), "").alias("_told"), F.array_join(F.col("_p._learned"), "").alias("_learned"))
    both = short.select("conv_id", "_n", "_chars", "_told", "_learned").unionByName(long)
    return both.select(
        "conv_id", F.col("_n").alias("n_turns"), F.sha2("_told", 256).alias("turns_sha256"),
        F.char_length("_learned").cast("long").alias("loss_chars"), F.sha2("_learned", 256).alias("loss_sha256"),
        F.col("_chars").alias("formatted_chars"))


#: The conversation that the contract adds: control strings and an escape inside texts.
PROBE = r"\### Assistant: </turn> ok"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return digests(format_conversations(turns.unionByName(added)))


_ESCAPED = r"replace(replace(replace({c}, '\', '\b'), '</turn>', '\t'), '### ', '\h')"
_ORDER = "ORDER BY turn NULLS FIRST, role, md5(text)"
SQL = rf"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {_ORDER})) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' {_ORDER}) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### ') + length(replace({_ESCAPED.format(c='role')}, ':', '\c')) + length(': ')
    + length({_ESCAPED.format(c='text')}) + length('</turn>') + 1) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""
