"""Chat formatting in windows of a token budget.

Turns become ``<|role|>\\ntext<|end|>\\n``. Control strings inside roles and
texts are taken apart by a backslash after their first character, once all
backslashes are doubled; ``unescape`` gives the text back.

A window holds whole turns: the conversation's system turn, some of the turns
before (repeated, never trained on), then new turns as far as prefix sums of
their tokens stay inside the budget. Every turn is new in exactly one window.
A turn that is larger than the budget has a window of its own, marked
``over_budget``. Loss spans are the texts of new assistant turns, as
(begin, end) in characters of ``formatted``.

Long conversations are dealt out in blocks of ``BLOCK`` turn numbers, each
packed by itself and given the last turns of the block before as history, so
no task sees more than a block of one conversation.

Defined results: NULL text or role: empty; NULL turn: before all others;
turns with equal numbers: by role, then text; repeated rows: turns of their
own; an empty table: no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import let, table

BLOCK = 64
BUDGET = 1024
HISTORY = 256
HISTORY_TURNS = 4
SYSTEM = "system"
TARGET = "assistant"
END = "end"

#: What marks turns here and in common templates.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]")
_OPENS = r"([<\[|])(?=\||>|/?s>|/?INST\])"
_OPENED = r"([<\[|])\\(?!\\)"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _OPENS, r"$1\\")


def unescape(text: Column) -> Column:
    once = F.regexp_replace(text, _OPENED, "$1")
    return F.replace(once, F.lit("\\\\"), F.lit("\\"))


def turn_tokens(text: Column) -> Column:
    """Words and single other characters, by which budgets are counted."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"],
                    F.lit(f"<|{END}|>\n"))


def _packed(turns: Column, room: Column, history: int) -> Column:
    """Turns of a block in order -> windows (from, to) of new turns, 0-based.

    ``before`` sums the tokens up to each turn, so a span's size is a difference.
    """
    start = F.struct(
        F.array().cast("array<int>").alias("begins"), F.lit(0).cast("long").alias("base"),
        F.lit(0).cast("long").alias("sum"), F.lit(0).alias("i"),
    )

    def step(acc, turn):
        after = acc["sum"] + turn["tokens"]
        fresh = ~turn["repeat"]
        opens = fresh & ((F.size(acc["begins"]) == 0) | (after - acc["base"] > room))
        return F.struct(
            F.when(opens, F.array_append(acc["begins"], acc["i"])).otherwise(acc["begins"])
            .alias("begins"),
            F.when(opens, acc["sum"]).otherwise(acc["base"]).alias("base"),
            after.alias("sum"), (acc["i"] + 1).alias("i"),
        )

    begins = F.aggregate(turns, start, step, lambda acc: acc["begins"])
    return let(begins, lambda b: F.transform(b, lambda at, k: F.struct(
        at.alias("low"), F.coalesce(F.get(b, k + 1), F.size(turns)).alias("high"))))


def _history_from(turns: Column, low: Column, room: int, most: int) -> Column:
    """Where the repeated turns before ``low`` begin: as many as fit, at most ``most``."""
    sums = F.aggregate(
        F.sequence(F.lit(1), F.lit(most)),
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("n"), F.lit(True).alias("go")),
        lambda acc, k: let(F.get(turns, low - k)["tokens"], lambda tokens: F.when(
            acc["go"] & (low - k >= 0) & (acc["sum"] + tokens <= room),
            F.struct((acc["sum"] + tokens).alias("sum"), k.alias("n"), F.lit(True).alias("go")),
        ).otherwise(F.struct(acc["sum"].alias("sum"), acc["n"].alias("n"),
                             F.lit(False).alias("go")))),
    )
    return low - sums["n"]


def windows(df: DataFrame, budget=BUDGET, history=HISTORY, history_turns=HISTORY_TURNS,
            conv="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """One row per window: conv_id, block, window, formatted, n_repeated, n_new,
    loss (array of begin, end), tokens, over_budget."""
    # A doubled turn number shifts no block: blocks go by the number itself.
    rows = df.select(
        F.col(conv).alias("conv_id"),
        F.coalesce(F.col(turn).cast("long"), F.lit(-(2**62))).alias("turn"),
        escape(F.coalesce(F.col(role), F.lit(""))).alias("role"),
        escape(F.coalesce(F.col(text), F.lit(""))).alias("text"),
    )
    block = F.floor(F.col("turn") / BLOCK)
    rows = rows.withColumn("tokens", turn_tokens(F.col("text")).cast("long")).withColumn(
        "block", block)
    fresh = rows.withColumn("repeat", F.lit(False))
    late = F.pmod(F.col("turn"), F.lit(BLOCK)) >= BLOCK - history_turns
    halo = rows.where(late).withColumn("block", F.col("block") + 1).withColumn(
        "repeat", F.lit(True))
    order = ("turn", "role", "text", "tokens", "repeat")
    blocks = (
        fresh.unionByName(halo).groupBy("conv_id", "block")
        .agg(F.array_sort(F.collect_list(F.struct(*order))).alias("turns"))
        .where(F.exists("turns", lambda t: ~t["repeat"]))
    )
    system = (
        rows.where(F.col("role") == SYSTEM).groupBy("conv_id")
        .agg(F.min(F.struct("turn", "role", "text", "tokens")).alias("system"))
    )
    by_conv = F.col("b.conv_id").eqNullSafe(F.col("s.conv_id"))
    joined = blocks.alias("b").join(system.alias("s"), by_conv, "left").select(
        "b.conv_id", "b.block", "b.turns", "s.system")
    reserved = F.coalesce(F.col("system.tokens"), F.lit(0)) + history
    room = F.greatest(F.lit(budget) - reserved, F.lit(1))
    packed = joined.select(
        "conv_id", "block", "turns", "system",
        F.posexplode(_packed(F.col("turns"), room, history)).alias("window", "span"))
    low, high = F.col("span.low"), F.col("span.high")
    begin = _history_from(F.col("turns"), low, history, history_turns)
    placed = packed.withColumn("begin", begin)
    # The system turn comes first unless it is among the window's turns anyway.
    inside = F.slice(F.col("turns"), F.col("begin") + 1, high - F.col("begin"))
    placed = placed.select(
        "conv_id", "block", "window", "system", inside.alias("turns"),
        (low - F.col("begin")).alias("n_history"), (high - low).alias("n_new"))
    lead = F.col("system").isNotNull() & ~F.exists(
        "turns", lambda t: (t["role"] == SYSTEM) & (t["turn"] == F.col("system.turn")))
    head = F.when(lead, F.array(F.struct(
        *(F.col(f"system.{c}").alias(c) for c in ("turn", "role", "text", "tokens")),
        F.lit(True).alias("repeat")))).otherwise(F.array().cast(
            "array<struct<turn:bigint,role:string,text:string,tokens:bigint,repeat:boolean>>"))
    placed = placed.select(
        "conv_id", "block", "window", "n_new", F.concat(head, "turns").alias("turns"),
        (F.col("n_history") + F.when(lead, 1).otherwise(0)).alias("n_repeated"))
    pieces = placed.withColumn("pieces", F.transform("turns", _rendered))
    tokens = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"])
    return pieces.select(
        "conv_id", "block", "window", F.array_join("pieces", "").alias("formatted"),
        "n_repeated", "n_new", _loss(F.col("turns"), F.col("pieces"), F.col("n_repeated"))
        .alias("loss"),
        tokens.alias("tokens"), (tokens > budget).alias("over_budget"),
    )


def _loss(turns: Column, pieces: Column, n_repeated: Column) -> Column:
    ends = F.aggregate(
        pieces, F.array(F.lit(0)),
        lambda acc, p: F.array_append(acc, F.element_at(acc, -1) + F.length(p)))
    tail = len(f"<|{END}|>\n")
    # A window has at most a block's turns and their history, so this stays small.
    spans = let(ends, lambda e: F.transform(turns, lambda t, i: F.when(
        (t["role"] == TARGET) & (i >= n_repeated), F.struct(
            (F.get(e, i) + F.length(t["role"]) + 5).alias("begin"),
            (F.get(e, i + 1) - tail).alias("end")))))
    return F.filter(spans, lambda s: s.isNotNull())


def turns_of(formatted: Column) -> Column:
    """The turns (role, text) of a window, repeated ones too, read from its text."""
    form = r"(?s)<\|(.*?)\|>\n(.*?)<\|end\|>\n"
    roles = F.regexp_extract_all(formatted, F.lit(form), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(form), F.lit(2))
    return F.zip_with(roles, texts, lambda r, t: F.struct(
        unescape(r).alias("role"), unescape(t).alias("text")))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, s["begin"] + 1, s["end"] - s["begin"]))), "")


def op8_chat_formatting(spark, sf_dir):
    """Digests of what is read back from the windows; a digest takes a whole
    conversation's text as one value."""
    fixed = spark.sql("""select conv_id, turn, role, '</s>[INST] ok [/INST]' as text from values
        (-7L, 0L, 'user'), (-7L, 1L, 'assistant') as t(conv_id, turn, role)""")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = windows(rows.unionByName(fixed))
    read = made.select(
        "conv_id", F.struct("block", "window").alias("place"),
        F.slice(turns_of(F.col("formatted")), F.col("n_repeated") + 1, 2**31 - 1).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss")).alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
    ).select(
        "conv_id", "place", F.size("turns").cast("long").alias("n"), "loss", "chars",
        F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("place", "said", "loss"))).alias("parts"))
    loss = F.array_join(F.col("parts.loss"), "")
    return whole.select(
        "conv_id", "n_turns",
        F.sha2(F.array_join(F.col("parts.said"), "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
