"""Linking of quotations in conversations, with DataFrame expressions only.

Lines that begin with ``>`` are quoted, one mark per level. Runs of lines of one level are
passages; passages are normalised, hashed and joined to the message of the same conversation
that said them first. The messages come back without quotes, each with the message it answers,
the start of its thread and its depth, which order a conversation by replies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import drop_written, written

_MARKS = r"^(?:[ \t]*>)+[ \t]?"


def _norm(text: Column) -> Column:
    """Lower case, with runs of white space and ASCII punctuation as one space."""
    return F.btrim(F.regexp_replace(F.lower(text), r"[\s\p{Punct}]+", " "))


def _key(text: Column) -> Column:
    """Hash and length of the normalised text; null where nothing is left of it."""
    norm = _norm(text)
    return F.when(norm != "", F.struct(F.xxhash64(norm).alias("hash"), F.length(norm).alias("size")))


def parsed(messages: DataFrame) -> DataFrame:
    """Add ``__passages``: array of (level, body) in order, of each whole ``text``."""
    lines = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\r\n|\r|\n")
    marked = messages.withColumn("__lines", F.transform(lines, lambda x: F.struct(
        (F.length(F.regexp_extract(x, _MARKS, 0)) - F.length(F.replace(F.regexp_extract(x, _MARKS, 0), F.lit(">"), F.lit(""))))
        .alias("level"), F.regexp_replace(x, _MARKS, "").alias("body"))))
    starts = marked.withColumn("__starts", F.expr(
        "filter(sequence(0, size(__lines) - 1), i -> i = 0 or get(__lines, i).level <> get(__lines, i - 1).level)"))
    return starts.withColumn("__passages", F.expr("""transform(__starts, (s, k) -> named_struct(
        'level', get(__lines, s).level,
        'body', array_join(transform(slice(__lines, s + 1, coalesce(get(__starts, k + 1), size(__lines)) - s), x -> x.body), '\n')))
        """)).drop("__lines", "__starts")


def _units(body: str) -> str:
    """SQL: a text, its paragraphs and its lines, with rank 0, 1 and 2."""
    return (f"concat(array(named_struct('rank', 0, 'part', {body})), "
            f"transform(split({body}, '\\n[ \\t]*\\n'), x -> named_struct('rank', 1, 'part', x)), "
            f"transform(split({body}, '\\n'), x -> named_struct('rank', 2, 'part', x)))")


def _roots(links: DataFrame) -> DataFrame:
    """(conv_id, turn, root, depth) of messages that answer another, by doubling steps.

    A message answers an earlier turn, so there are no rings; rounds are the logarithm of the
    longest chain.
    """
    now = written(links.select("conv_id", "turn", F.col("reply_to").alias("root"), F.lit(1).alias("depth")), "threads")
    while True:
        above = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("__r"), F.col("depth").alias("__d"))
        step = now.join(above, ["conv_id", "root"], "left").select(
            "conv_id", "turn", F.coalesce("__r", "root").alias("root"),
            (F.col("depth") + F.coalesce("__d", F.lit(0))).alias("depth"), F.col("__r").isNotNull().alias("moved"))
        step = written(step, "threads")
        moved = step.where("moved").limit(1).count()
        drop_written(now)
        now = step
        if not moved:
            return now.drop("moved")


def link_quotes(messages: DataFrame) -> DataFrame:
    """Conversations without quotes, ordered by replies, from (conv_id, turn, role, text).

    One row per message: conv_id, turn, role, text (level 0 lines), n_quotes (quoted passages),
    n_linked (those found in an earlier message of the conversation), reply_to (of the level 1
    passages that were found, the latest turn), thread (the turn that the chain of replies
    starts from, its own without one) and depth (replies before it). Ordered by (conv_id, thread,
    depth, turn) every message stands behind the one it answers.

    A passage is looked up whole, else by its paragraphs, else by its lines, among whole
    messages, paragraphs and lines; the first message that has it is its origin. Null texts count
    as empty; rows with a null conv_id or turn link with nothing; rows repeated under one turn
    are all returned and share one place; passages of punctuation only have no origin; an empty
    table gives no rows; other columns are ignored. Nothing is gathered by conversation.
    """
    base = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = parsed(base).withColumn("own", F.expr(
        "array_join(transform(filter(__passages, p -> p.level = 0), p -> p.body), '\n')")).withColumn(
        "quotes", F.expr("filter(__passages, p -> p.level > 0)")).select("conv_id", "turn", "role", "own", "quotes")
    origins = rows.where("conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.explode(F.expr(f"array_distinct({_units('own')})")).alias("u"))
    origins = origins.select("conv_id", "turn", _key(F.col("u.part")).alias("key")).where("key is not null")
    origins = origins.groupBy("conv_id", "key").agg(F.min("turn").alias("origin"))
    quoted = rows.where("size(quotes) > 0 and conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.posexplode("quotes").alias("place", "q"))
    units = quoted.select("conv_id", "turn", "place", F.col("q.level").alias("level"), F.explode(F.expr(_units("q.body"))).alias("u"))
    units = units.select("conv_id", "turn", "place", "level", "u.rank", _key(F.col("u.part")).alias("key")).where("key is not null")
    hits = units.join(origins, ["conv_id", "key"]).where("origin < turn")
    # Of a passage the best kind of hit counts; of equal kinds the latest message.
    best = hits.groupBy("conv_id", "turn", "place", "level").agg(
        F.max(F.struct((-F.col("rank")).alias("rank"), "origin")).alias("hit"))
    of_message = best.groupBy("conv_id", "turn").agg(
        F.count("*").alias("n_linked"), F.max(F.when(F.col("level") == 1, F.col("hit.origin"))).alias("reply_to"))
    of_message = written(of_message, "links")
    threads = _roots(of_message.where("reply_to is not null"))
    out = rows.join(of_message, ["conv_id", "turn"], "left").join(threads, ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", "role", F.col("own").alias("text"), F.size("quotes").cast("long").alias("n_quotes"),
                      F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "reply_to",
                      F.coalesce("root", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))
