"""Reply trees to training conversations, one per chosen root-to-leaf path.

Paths are found by self-joins whose reach doubles each round, so a thread of n replies takes
log2(n) rounds. Only ids and scores move in these rounds; texts join at the end. A formatted
conversation is one string, so one path must fit a single value.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.shared import written

# Fixed values of the template: <turn ROLE>, a line break, the text, </turn>, a line break.
OPEN, CLOSE = "<turn ", "</turn>\n"
ROLE_END = ">"


def escape(text: Column) -> Column:
    r"""Backslashes doubled, then a backslash put into what could be read as a mark."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("<turn"), F.lit("<\\turn"))
    return F.replace(text, F.lit("</turn"), F.lit("<\\/turn"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(ROLE_END), F.lit("\\g"))


def _between_backslashes(text: Column, body) -> Column:
    """body applied between doubled backslashes, which become single ones."""
    return F.array_join(F.transform(F.split(text, r"\\\\"), body), "\\")


def unescape(text: Column) -> Column:
    return _between_backslashes(text, lambda part: F.replace(
        F.replace(part, F.lit("<\\turn"), F.lit("<turn")), F.lit("<\\/turn"), F.lit("</turn")))


def unescape_role(role: Column) -> Column:
    return _between_backslashes(role, lambda part: F.replace(F.replace(
        F.replace(part, F.lit("<\\turn"), F.lit("<turn")), F.lit("<\\/turn"), F.lit("</turn")),
        F.lit("\\g"), F.lit(ROLE_END)))


def thread_messages(rows: DataFrame, tree: str = "conv_id", turn: str = "turn",
                    role: str = "role", text: str = "text") -> DataFrame:
    """Rows in turns as messages, each the reply to the row before it.

    Order is by turn (null first), then role and text; every row is a message of its own, also
    when rows repeat. Rows with a null conversation form one conversation.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    return (
        rows.select(F.col(tree).alias("tree"), F.col(turn).alias("turn"),
                    F.col(role).alias("role"), F.col(text).alias("text"))
        .withColumn("node", F.row_number().over(order).cast("long"))
        .select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                "role", "text", F.lit(0.0).alias("score")))


def _same(mine: str, theirs: str) -> Column:
    """Equality of trees (null equals null) and of a column of each side."""
    return F.col("tree").eqNullSafe(F.col("their_tree")) & (F.col(mine) == F.col(theirs))


def format_paths(messages: DataFrame, top: int | None = None,
                 learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per chosen path: tree, leaf, path_rank, score, n_turns, formatted, loss_spans.

    ``messages`` has tree, node, parent, role, text, score. A branch scores the sum along its
    path (null: 0); branches of a tree are ranked by score, then leaf, and ``top`` of them are
    formatted (all, if None). ``loss_spans`` are (start, length) in code points of the texts
    whose role is in ``learn``.

    A parent that does not exist makes a root. Messages without node are left out, as nothing
    can name them; of messages with the same tree and node the one with the smallest parent,
    role and text counts. Replies in a circle have no root, hence no path. Null role and text
    are empty. Other columns are not looked at. An empty table gives no rows.
    """
    known = messages.select("tree", "node", "parent", "role", "text",
                            F.coalesce("score", F.lit(0.0)).alias("score")).filter("node IS NOT NULL")
    single = known.groupBy("tree", "node").agg(F.min(F.struct("parent", "role", "text", "score"))
                                               .alias("m"))
    known = written(single.select("tree", "node", "m.*"), "chat-messages")
    parents = known.select(F.col("tree").alias("their_tree"), F.col("node").alias("above"))
    jump = written(
        known.join(parents, _same("parent", "above"), "left")
        .select("tree", "node", "above", "score", F.lit(1).cast("long").alias("depth")),
        "chat-jump")
    n = known.count()
    ended, climbing, jumps = jump.filter("above IS NULL"), jump.filter("above IS NOT NULL"), []
    # Beyond 2^rounds = n only circles are still climbing.
    while 2 ** len(jumps) <= n and not climbing.isEmpty():
        jumps.append(climbing)
        ahead = ended.unionByName(climbing).select(
            F.col("tree").alias("their_tree"), F.col("node").alias("at"),
            F.col("above").alias("next"), F.col("score").alias("more"),
            F.col("depth").alias("further"))
        jump = written(
            climbing.join(ahead, _same("above", "at"))
            .select("tree", "node", F.col("next").alias("above"),
                    (F.col("score") + F.col("more")).alias("score"),
                    (F.col("depth") + F.col("further")).alias("depth")),
            "chat-jump")
        ended = ended.unionByName(jump.filter("above IS NULL"))
        climbing = jump.filter("above IS NOT NULL")

    answered = known.select(F.col("tree").alias("their_tree"),
                            F.col("parent").alias("replied")).distinct()
    leaves = ended.join(answered, _same("node", "replied"), "left_anti")
    rank = F.row_number().over(
        Window.partitionBy("tree").orderBy(F.col("score").desc(), F.col("node")))
    leaves = leaves.select("tree", F.col("node").alias("leaf"), "depth", "score",
                           rank.alias("path_rank"))
    if top is not None:
        leaves = leaves.filter(F.col("path_rank") <= top)

    growing = written(leaves.withColumn("node", F.col("leaf"))
                      .withColumn("back", F.lit(0).cast("long")), "chat-paths")
    paths = []
    for k, step in enumerate(jumps):
        paths.append(growing.filter(F.col("depth") <= 2 ** k))
        step = step.select(F.col("tree").alias("their_tree"), F.col("node").alias("at"), "above")
        growing = written(
            growing.filter(F.col("depth") > 2 ** k).join(step, _same("node", "at"), "left")
            .select("tree", "leaf", "depth", "score", "path_rank", F.explode(F.filter(
                F.array(F.struct("node", "back"),
                        F.struct(F.col("above").alias("node"),
                                 (F.col("back") + 2 ** k).alias("back"))),
                lambda s: s["node"].isNotNull())).alias("s"))
            .select("tree", "leaf", "depth", "score", "path_rank", "s.*"), "chat-paths")
    path = reduce(DataFrame.unionByName, paths, growing)
    texts = known.select(F.col("tree").alias("their_tree"), F.col("node").alias("at"), "role", "text")
    turns = path.join(texts, _same("node", "at")).select(
        "tree", "leaf", "path_rank", "score", (F.col("depth") - F.col("back")).alias("pos"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.concat(F.lit(OPEN), escape_role(F.coalesce("role", F.lit(""))), F.lit(ROLE_END + "\n"))
        .alias("head"), escape(F.coalesce("text", F.lit(""))).alias("body"))
    before = Window.partitionBy("tree", "leaf").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(CLOSE)
    placed = turns.withColumn(
        "start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    listed = placed.groupBy("tree", "leaf", "path_rank", "score").agg(F.array_sort(F.collect_list(
        F.struct("pos", "role", "start", F.length("body").cast("long").alias("length"),
                 F.concat("head", "body", F.lit(CLOSE)).alias("turn")))).alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["role"].isin(*learn)),
                        lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    return listed.select("tree", "leaf", "path_rank", "score",
                         F.size("turns").cast("long").alias("n_turns"),
                         F.array_join("turns.turn", "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> back from a formatted conversation."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")

    def turn(block):
        role = F.substring_index(block, ROLE_END, 1)
        text = F.substring(block, F.length(role) + 3, F.length(block))
        return F.struct(unescape_role(F.substring(role, len(OPEN) + 1, F.length(role))).alias("role"),
                        unescape(text).alias("text"))

    return F.transform(blocks, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """array<string> of the unescaped texts under the loss mask."""
    return F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
