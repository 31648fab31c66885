"""Chat formatting by quotation linking.

1. Every line of a message is parsed into its quote level (the number of leading ``>``, spaces
   between them allowed) and its content.  Runs of lines of one level >= 1 are quoted passages;
   lines of level 0 are the message's own text.
2. Own text and passages are normalised (lower case, letters and digits, single spaces) and
   hashed in units: the whole, every line, and every run of ``RUN_WORDS`` words across line ends,
   so that a sentence out of a longer line or a re-wrapped quote is found too.
3. Each unit of a passage votes for the latest earlier message of the conversation that holds it
   in its own text.  A passage's original is the message its whole text votes for, else the one
   with the most votes; ties go to the latest.  A message replies to the original of its
   outermost linked passage (lowest quote level), the latest of these.
4. Depth and thread root follow the reply links by pointer doubling.  A conversation's order puts
   threads by their first message, and in a thread every message after the one it replies to.

Texts lose their quoted lines and the attribution line before a quote (``... wrote:``).

All DataFrame functions.  Work is keyed by message or by (conversation, unit hash, block of
``BLOCK_TURNS`` turns), never by a whole conversation: the latest earlier holder of a unit is found
inside its block, or else is the highest one of the blocks before it, so a unit that very many
messages of one conversation hold and quote costs a row for each of them, not one for each pair.
Positions are ranked in buckets, so a conversation that holds a third of all messages is dealt over
many tasks.  Only conversations that quote are cut into units.

Defined cases: a null text is empty; null conv_id and null turn are values like others (nulls
first), but a message without a turn neither quotes nor is quoted; rows that repeat (conv_id,
turn) share their quotes and links; quotes that match nothing are removed all the same;
``>`` inside a line is text; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.common import discard, stratified_rank, written

RUN_WORDS = 5
BLOCK_TURNS = 4096
PREFIX = r"^((?:[ \t]*>)*)"
ATTRIBUTION = r"(?i)\bwrote:[ \t]*$"


def _norm(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def parse(messages: DataFrame) -> DataFrame:
    """Messages with ``lines``: an array of (level, content, gone) in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = F.transform(F.split(text, "\n"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, PREFIX, 1), "[^>]", "")).alias("level"),
        F.regexp_replace(x, PREFIX + r"[ \t]?(?=\S|$)", "").alias("inner"), x.alias("line")))
    split = F.transform(split, lambda x: F.struct(
        x["level"].alias("level"), F.when(x["level"] > 0, x["inner"]).otherwise(x["line"]).alias("content")))
    rows = messages.select("conv_id", "turn", "role", text.alias("text"), split.alias("l"))
    lead = F.transform("l", lambda x, i: F.struct(
        x["level"].alias("level"), x["content"].alias("content"),
        ((x["level"] == 0) & x["content"].rlike(ATTRIBUTION)
         & (F.coalesce(F.get(F.col("l"), i + 1)["level"], F.lit(0)) > 0)).alias("gone")))
    return rows.select("conv_id", "turn", "role", "text", lead.alias("lines"))


def _own(parsed: DataFrame) -> Column:
    return F.transform(F.filter("lines", lambda x: (x["level"] == 0) & ~x["gone"]), lambda x: x["content"])


def _passages(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, p, level, texts) of the runs of equal level >= 1, cut out at their bounds."""
    level = lambda i: F.get(F.col("lines"), i)["level"]
    starts = F.filter(F.sequence(F.lit(0), F.size("lines") - 1),
                      lambda i: ~level(i).eqNullSafe(F.when(i > 0, level(i - 1))))
    bounded = parsed.withColumn("starts", starts)
    runs = F.transform("starts", lambda x, j: F.struct(
        level(x).alias("level"),
        F.slice("lines", x + 1, F.coalesce(F.get("starts", j + 1), F.size("lines")) - x).alias("run")))
    cut = bounded.select("conv_id", "turn", F.posexplode(F.filter(runs, lambda r: r["level"] > 0)).alias("p", "x"))
    return cut.select("conv_id", "turn", "p", F.col("x.level").alias("level"), F.col("x.run.content").alias("texts"))


def _units(df: DataFrame, texts: Column, *keys: str) -> DataFrame:
    """(keys, u, whole): the distinct unit hashes of a text given as lines, without empty ones."""
    normed = df.select(*keys, F.filter(F.transform(texts, _norm), lambda x: x != "").alias("each"))
    joined = normed.where(F.size("each") > 0).withColumn("all", F.array_join("each", " "))
    words = joined.withColumn("w", F.split("all", " "))
    runs = F.transform(
        F.when(F.size("w") >= RUN_WORDS, F.sequence(F.lit(1), F.size("w") - (RUN_WORDS - 1)))
        .otherwise(F.array().cast("array<int>")),
        lambda i: F.array_join(F.slice("w", i, RUN_WORDS), " "))
    unit = F.explode(F.array_union(F.array("all"), F.array_union("each", runs))).alias("x")
    return words.select(*keys, "all", unit).select(
        *keys, F.md5(F.col("x").cast("binary")).alias("u"), (F.col("x") == F.col("all")).alias("whole"))


def latest_before(asked: DataFrame, held: DataFrame) -> DataFrame:
    """``asked`` (conv_id, u, turn) with ``orig``: the highest ``orig`` below turn among the rows
    of ``held`` (conv_id, u, orig); rows without one are left out.  Both sides are distinct."""
    block = F.floor(F.col("at") / BLOCK_TURNS)
    rows = (asked.select("conv_id", "u", F.col("turn").alias("at"), F.lit(False).alias("holds"))
            .union(held.select("conv_id", "u", F.col("orig").alias("at"), F.lit(True).alias("holds")))
            .withColumn("block", block))
    top = (rows.where("holds").groupBy("conv_id", "u", "block").agg(F.max("at").alias("top"))
           .union(rows.where("not holds").select("conv_id", "u", "block", F.lit(None).alias("top")).distinct()))
    top = top.groupBy("conv_id", "u", "block").agg(F.max("top").alias("top"))
    lower = Window.partitionBy("conv_id", "u").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    top = top.select(F.col("conv_id").alias("c"), F.col("u").alias("v"), F.col("block").alias("b"),
                     F.max("top").over(lower).alias("before"))
    # At one turn an asking row stands before a holding one: a message does not quote itself.
    near = Window.partitionBy("conv_id", "u", "block").orderBy("at", "holds")
    inside = rows.withColumn("last", F.max(F.when(F.col("holds"), F.col("at"))).over(near)).where("not holds")
    found = inside.join(top, inside["conv_id"].eqNullSafe(top["c"]) & (inside["u"] == top["v"])
                        & (inside["block"] == top["b"]))
    return found.select("conv_id", "u", F.col("at").alias("turn"),
                        F.coalesce("last", "before").alias("orig")).where("orig IS NOT NULL")


def link(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to) of the messages with a linked passage."""
    timed = parsed.where(F.col("turn").isNotNull())
    quoting = timed.where(F.exists("lines", lambda x: x["level"] > 0))
    asked = _units(_passages(quoting), F.col("texts"), "conv_id", "turn", "p", "level")
    asked = written(asked.groupBy("conv_id", "turn", "p", "level", "u").agg(F.max("whole").alias("whole")),
                    "quote-units")

    def among(rows: DataFrame, *keys: str) -> DataFrame:
        """``rows`` whose keys stand in ``asked``, conv_id null-safe."""
        k = asked.select(*[F.col(x).alias(f"__{x}") for x in keys]).distinct()
        on = [rows[x].eqNullSafe(k[f"__{x}"]) for x in keys]
        return rows.join(k, on, "left_semi")

    talks = among(timed.select("conv_id", F.col("turn").alias("orig"), _own(timed).alias("own")), "conv_id")
    held = among(_units(talks, F.col("own"), "conv_id", "orig"), "conv_id", "u")
    held = written(held.select("conv_id", "u", "orig").distinct(), "quote-held")
    votes = latest_before(asked.select("conv_id", "u", "turn").distinct(), held).select(
        F.col("conv_id").alias("c"), F.col("u").alias("v"), F.col("turn").alias("t"), "orig")
    hit = asked.join(votes, asked["conv_id"].eqNullSafe(votes["c"]) & (asked["u"] == votes["v"])
                     & (asked["turn"] == votes["t"]))
    score = hit.groupBy("conv_id", "turn", "p", "level", "orig").agg(
        F.max("whole").alias("full"), F.count(F.lit(1)).alias("n"))
    best = score.groupBy("conv_id", "turn", "p", "level").agg(
        F.max(F.struct("full", "n", "orig")).alias("b"))
    return best.groupBy("conv_id", "turn").agg(
        F.max(F.struct((-F.col("level")).alias("l"), F.col("b.orig").alias("reply_to"))).alias("r")
    ).select("conv_id", "turn", "r.reply_to")


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, depth, root) by pointer doubling over the reply links."""
    state = written(links.select("conv_id", "turn", "reply_to", F.col("reply_to").alias("root"),
                                 F.lit(1).alias("depth"), F.lit(True).alias("moved")), "quote-depth")
    while True:
        up = state.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"),
                          F.col("root").alias("up"), F.col("depth").alias("more"))
        nxt = written(state.join(up, state["conv_id"].eqNullSafe(up["c"]) & (state["root"] == up["t"]),
                                 "left").select(
            "conv_id", "turn", "reply_to", F.coalesce("up", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("up").isNotNull().alias("moved")), "quote-depth")
        discard(state)
        state = nxt
        if state.where("moved").isEmpty():
            return state.drop("moved")


def format_chats(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, position, reply_to, depth, thread, n_quoted, body)."""
    parsed = parse(messages)
    replies = threads(link(parsed))
    body = F.trim(F.array_join(_own(parsed), "\n"), F.lit(" \t\n"))
    quoted = F.size(F.filter("lines", lambda x: x["level"] > 0))
    rows = parsed.select("conv_id", "turn", "role", quoted.alias("n_quoted"), body.alias("body"))
    r = replies.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "reply_to", "depth", "root")
    rows = rows.join(r, rows["conv_id"].eqNullSafe(r["c"]) & (rows["turn"] == r["t"]), "left").select(
        "conv_id", "turn", "role", "reply_to", F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("root", "turn").alias("thread"), "n_quoted", "body")
    rows = written(rows, "quote-rows")
    # A conversation's threads in equal ranges of its turns, so that ranks can be counted apart.
    span = rows.groupBy(F.col("conv_id").alias("c")).agg(
        F.min("thread").alias("lo"), F.max("thread").alias("hi"), F.count(F.lit(1)).alias("n"))
    wide = rows.join(span, rows["conv_id"].eqNullSafe(span["c"])).drop("c")
    parts = F.ceil(F.sqrt("n"))
    bucket = F.coalesce(F.floor((F.col("thread") - F.col("lo")) * parts / (F.col("hi") - F.col("lo") + 1)),
                        F.lit(-1))
    order = [F.col(c).asc_nulls_first() for c in ("thread", "depth", "turn", "role", "n_quoted", "body")]
    ranked = stratified_rank(wide, ["conv_id"], bucket, order, "position")
    return ranked.select("conv_id", "turn", "role", (F.col("position") - 1).alias("position"),
                         "reply_to", "depth", "thread", "n_quoted", "body")


def contract(messages: DataFrame) -> DataFrame:
    return format_chats(messages.select("conv_id", "turn", "role", "text"))
