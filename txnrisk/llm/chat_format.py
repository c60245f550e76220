"""Conversations as training text, by Spark expressions only.

A conversation's turns are collected as structs and sorted; array expressions
merge adjacent turns of one role into a block; the blocks are concatenated:

    ### user:
    first text</turn>
    second text</turn>
    ### assistant:
    answer</turn>

Every turn keeps its end mark, so merged turns can be told apart again. In
texts and roles, backslash, ``###`` and ``</turn>`` become ``\\b``, ``\\h`` and
``\\l`` (in roles also colon and line feed, ``\\c`` and ``\\n``). So no control
string is left in them, each backslash begins one escape, and plain
replacements undo it. The loss mask lists the spans of the assistant's texts.

Defined results: turns are sorted by turn, nulls first, then role, then text,
and repeated rows are kept; a null text is empty, a null role too; rows with a
null conv_id are one conversation; an empty table gives an empty result;
columns beyond the four named are not looked at. A conversation's text is one
value, so it has to fit one row, 2 GB.

Spark copies the state of an array's fold at every step, so nothing is gathered
in one: arrays are made by transforms and slices, and offsets are added up in
two levels.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings, the escapes, and the role that is learned.
HEADER, HEADER_END, TURN_END = "### ", ":\n", "</turn>\n"
TEXT_ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\l"))
ROLE_ESCAPES = (*TEXT_ESCAPES, (":", "\\c"), ("\n", "\\n"))
LEARNED = "assistant"

#: Sizes that are added up one by one; longer runs go by their sums.
PART = 128


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often a lambda in it runs."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sum(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x)


def _before(sizes: Column) -> Column:
    """For each size the sum of those before it."""

    def by_parts(s: Column) -> Column:
        last = F.greatest(F.ceil(F.size(s) / PART).cast("int") - 1, F.lit(0))
        sums = F.transform(F.sequence(F.lit(0), last), lambda k: _sum(F.slice(s, k * PART + 1, F.lit(PART))))

        def inside(before: Column) -> Column:
            return F.transform(
                s,
                lambda _, i: F.get(before, F.floor(i / PART).cast("int"))
                + _sum(F.slice(s, i - i % PART + 1, i % PART)),
            )

        parts = _let(sums, lambda b: F.transform(b, lambda _, k: _sum(F.slice(b, F.lit(1), k))))
        return _let(parts, inside)

    return _let(sizes, by_parts)


def _replaced(value: Column, pairs) -> Column:
    for old, new in pairs:
        value = F.replace(value, F.lit(old), F.lit(new))
    return value


def escaped(value: Column, pairs=TEXT_ESCAPES) -> Column:
    return _replaced(value, pairs)


def unescaped(value: Column, pairs=TEXT_ESCAPES) -> Column:
    """The escapes undone; the backslash comes last, so that it starts no other escape."""
    return _replaced(value, [(new, old) for old, new in reversed(pairs)])


def _blocks(turns: Column) -> Column:
    """The text of each run of turns of one role, under its header."""

    def of_turns(t: Column) -> Column:
        def first(i: Column) -> Column:
            return (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"])

        def of_firsts(f: Column) -> Column:
            def block(at: Column, k: Column) -> Column:
                run = F.slice(t, at + 1, F.coalesce(F.get(f, k + 1), F.size(t)) - at)
                bodies = F.transform(run, lambda x: F.concat(escaped(x["text"]), F.lit(TURN_END)))
                header = F.concat(F.lit(HEADER), F.get(t, at)["role"], F.lit(HEADER_END))
                return F.concat(header, F.array_join(bodies, ""))

            return F.transform(f, block)

        return _let(F.filter(F.sequence(F.lit(0), F.size(t) - 1), first), of_firsts)

    return _let(turns, of_turns)


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, ``formatted`` and ``loss_mask``, an array of (start, stop) in code points."""
    role = escaped(F.coalesce("role", F.lit("")), ROLE_ESCAPES)
    text = F.coalesce("text", F.lit(""))
    row = F.struct("turn", role.alias("role"), text.alias("text"))
    sorted_turns = F.sort_array(F.collect_list(row))
    collected = turns.groupBy("conv_id").agg(sorted_turns.alias("turns"))
    text_of = collected.select("conv_id", F.array_join(_blocks(F.col("turns")), "").alias("formatted"))
    mask = F.transform(
        F.filter(read("formatted"), lambda t: t["role"] == LEARNED),
        lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop")),
    )
    return text_of.withColumn("loss_mask", mask)


def _turns_of(block: Column) -> Column:
    """A block without its first mark: role, text, size in code points, and what of the header lies before it."""
    role = F.substring_index(block, HEADER_END, 1)
    skip = F.length(role) + len(HEADER) + len(HEADER_END)
    pieces = F.split(F.substring(block, F.length(role) + len(HEADER_END) + 1, F.length(block)), TURN_END, -1)
    turns = F.transform(
        pieces,
        lambda x, i: F.struct(
            unescaped(role, ROLE_ESCAPES).alias("role"),
            unescaped(x).alias("text"),
            F.length(x).cast("long").alias("size"),
            F.when(i == 0, skip).otherwise(0).cast("long").alias("skip"),
        ),
    )
    # Behind the last end mark there is nothing.
    return _let(turns, lambda t: F.slice(t, F.lit(1), F.size(t) - 1))


def read(formatted: str) -> Column:
    """The turns of a formatted text: role, text, and where the escaped text starts and stops."""
    blocks = F.split(F.col(formatted), HEADER, -1)
    blocks = _let(blocks, lambda b: F.slice(b, F.lit(2), F.size(b) - 1))

    def placed(t: Column) -> Column:
        def with_starts(before: Column) -> Column:
            def turn(x: Column, i: Column) -> Column:
                start = F.get(before, i) + x["skip"]
                return F.struct(
                    x["role"].alias("role"),
                    x["text"].alias("text"),
                    start.alias("start"),
                    (start + x["size"]).alias("stop"),
                )

            return F.transform(t, turn)

        widths = F.transform(t, lambda x: x["skip"] + x["size"] + len(TURN_END))
        return _let(_before(widths), with_starts)

    return _let(F.flatten(F.transform(blocks, _turns_of)), placed)


def _under(mask: Column, turns: Column) -> Column:
    """The texts of the turns that are spans of the mask, in order: each is sorted behind its span."""
    spans = F.transform(mask, lambda m: F.struct(m["start"], m["stop"], F.lit(0).alias("kind"), F.lit("").alias("text")))
    texts = F.transform(turns, lambda t: F.struct(t["start"], t["stop"], F.lit(1).alias("kind"), t["text"]))

    def found(s: Column) -> Column:
        def hit(x: Column, i: Column) -> Column:
            last = F.get(s, i - 1)
            same = (last["start"] == x["start"]) & (last["stop"] == x["stop"]) & (last["kind"] == 0)
            return (x["kind"] == 1) & F.coalesce(same, F.lit(False))

        return F.transform(F.filter(s, hit), lambda x: x["text"])

    return _let(F.sort_array(F.concat(spans, texts)), found)


def digest(conversations: DataFrame) -> DataFrame:
    """Counts and checksums of what is read back from the rows of ``formatted``."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(_under(F.col("loss_mask"), F.col("turns")), "")
    found = conversations.withColumn("turns", read("formatted")).withColumn("loss", loss)
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
