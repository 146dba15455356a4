"""Spelling variants: words that differ by one code point, found by a relational trie frontier.

Words are counted over all texts. A trie of the words is a distributed edge table: node (the
hash of a beginning), next letter, child, the number of words below. States (word, position,
node, edits) start at the node of half the word, since two words one edit apart share the first
or the last half of either: so there is one trie of the words and one of the words reversed,
and states never meet the crowded nodes near the root. Level by level the states are joined with
the edges of their depth: a state without edit follows its own letter, or skips, adds or replaces
one; a state with one edit must follow its own letters. An edge knows the letters that may
follow and a few bits of the rests of the words below, so dead states are mostly not made, and an edge with one word below ends the walk by a
comparison of what is left. States that reach a word's end are neighbours; their texts
are compared once more, so a clash of hashes never shows.

An edit is placed behind the longest common beginning, so every pair comes up once. A level reads
only the words whose length fits it and writes its states to the shared folder; nothing is gathered
on the driver but the distinct lengths. A crowded node is a key of a join whose edge side has one row for each
letter, which adaptive execution splits. There are as many levels as the longest beginning that
two words share behind half the length.

Defined results: null and empty texts have no words; a null id counts as an empty one in the hash that
drops a letter; rows repeated count each time; ties of the most frequent neighbour go to the
smallest in code-point order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import materialized, slices
from fieldmart.session import scratch_path

LEAST_LETTERS = 7
LEAST_COUNT = 2
#: A form is so many times as frequent as the word.
FORM_RATIO = 10
DROP_EACH = 31
#: Distinct words that a task counts before it passes them on.
COUNTED_WORDS = 200_000

#: Letters as Latin-1 bytes, behind the lower-casing of A-Z.
_LETTERS = r"[a-z\xc0-\xff]"


def doc_words(doc_id: str, text: str, run: re.Pattern, least_letters: int = LEAST_LETTERS) -> Iterator[tuple[bytes, int]]:
    """The words of a text with their numbers, as Latin-1 bytes; a hash of id and word drops one letter of some."""
    found = Counter(run.findall(text.encode("latin-1", "replace").lower()))
    seed = zlib.crc32(f"{doc_id}:".encode())
    for word, n in found.items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
        if h % DROP_EACH == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
            if len(word) < least_letters:
                continue
        yield word, n


def count_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_letters: int = LEAST_LETTERS,
                least_count: int = LEAST_COUNT) -> DataFrame:
    """Rows (word, n) of the words that occur often enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = re.compile(_LETTERS.encode("latin-1") + b"{%d,}" % least_letters)
        counts: dict[bytes, int] = {}

        def emit():
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()),
                                              pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for b in slices(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for word, n in doc_words(doc_id, text, letters, least_letters):
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > COUNTED_WORDS:
                    yield emit()
        yield emit()

    rows = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"),
                       F.col(text_column).alias("text")).filter("text is not null")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _edges(ways: DataFrame, depth: int) -> DataFrame:
    """The trie's edges from nodes of this depth: letter (0: the word ends), child, words below, and what may follow.

    What may follow is a bit for each next letter, and a bit of 128 for the hash of each word's rest.
    """
    follows = f"ascii(substring(text, {depth + 2}, 1))"
    return ways.filter(f"len >= {depth} and len <= {2 * depth + 2}").selectExpr(
        f"xxhash64(way, left(text, {depth})) as node", f"ascii(substring(text, {depth + 1}, 1)) as letter", "id",
        f"xxhash64(way, left(text, {depth + 1})) as child", f"xxhash64(substring(text, {depth + 2})) as rest",
        f"case when {follows} = 0 then 1L << 26 when {follows} < 192 then 1L << ({follows} - 97) else 0L end as low",
        f"case when {follows} >= 192 then 1L << ({follows} - 192) else 0L end as high",
        "case when rest & 64 = 0 then 1L << cast(rest & 63 as int) else 0L end as even",
        "case when rest & 64 = 64 then 1L << cast(rest & 63 as int) else 0L end as odd",
    ).groupBy("node", "letter").agg(
        F.count("*").alias("below"), F.min("id").alias("only"), F.min("child").alias("child"), F.min("rest").alias("rest"),
        *[F.expr(f"bit_or({mask})").alias(mask) for mask in ("low", "high", "even", "odd")])


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states behind one more edge; `found` marks those that have ended in the word `only`."""
    joined = states.withColumns({
        "own": F.expr("ascii(substring(text, at + 1, 1))"), "after": F.expr("ascii(substring(text, at + 2, 1))")}).join(edges, "node")
    # each edge allows up to five moves, as numbers 2 * to + edited, -1 for none: cheaper than arrays of structs
    moves = joined.selectExpr("*", """explode(array(
        if(edits = 0 and letter = own and own <> 0 and below > 1, 2 * (at + 1), -1),
        if(edits = 0 and letter <> own and letter <> 0 and own <> 0, 2 * (at + 1) + 1, -1),
        if(edits = 0 and letter <> own and letter <> 0, 2 * at + 1, -1),
        if(edits = 0 and own <> 0 and after <> own and letter = after, 2 * (at + 2) + 1, -1),
        if(edits = 1 and letter = own, 2 * (at + 1) + 1, -1))) as move""").filter("move >= 0")
    moves = moves.withColumns({"to": F.expr("shiftright(move, 1)"), "edited": F.expr("move & 1")})
    ahead, bit = "ascii(substring(text, to + 1, 1))", "cast(left_over & 63 as int)"
    return moves.withColumn("left_over", F.expr("xxhash64(substring(text, to + 1))")).filter(
        f"""edited = 0 or letter = 0 or (below = 1 and left_over = rest) or (below > 1
        and if(left_over & 64 = 0, even >> {bit}, odd >> {bit}) & 1 = 1
        and case when {ahead} = 0 then low >> 26 when {ahead} < 192 then low >> ({ahead} - 97) else high >> ({ahead} - 192) end & 1 = 1)"""
    ).selectExpr("id", "n", "text", "way", "to as at", "child as node", "edited as edits",
                 "edited = 1 and (letter = 0 or below = 1) as found", "only")


def neighbours(words: DataFrame) -> DataFrame:
    """Rows (word, n, near, near_n), both ways round, of the distinct words one edit apart. `words`: (word, n)."""
    spark = words.sparkSession
    words = materialized(words.select("word", "n", F.monotonically_increasing_id().alias("id")), "spelling-words")
    ways = words.selectExpr("id", "n", "length(word) as len", "inline(array(struct(false as way, word as text), struct(true as way, reverse(word) as text)))")
    halves = sorted(r[0] for r in words.select(F.expr("cast(length(word) / 2 as int)")).distinct().collect())
    folder, levels = scratch_path(spark, "spelling-levels"), []
    carried, depth = None, None
    while carried is not None or halves:
        depth = depth + 1 if carried is not None else halves[0]
        states = None
        if halves and halves[0] == depth:
            halves.pop(0)
            states = ways.filter(f"cast(len / 2 as int) = {depth}").selectExpr(
                "id", "n", "text", "way", f"{depth} as at", f"xxhash64(way, left(text, {depth})) as node", "0 as edits")
        if carried is not None:
            carried = carried.select("id", "n", "text", "way", "at", "node", "edits")
            states = carried if states is None else states.unionByName(carried)
        levels.append(f"{folder}/{depth}")
        _step(states, _edges(ways, depth)).write.parquet(levels[-1])
        carried = spark.read.parquet(levels[-1]).filter("not found")
        if carried.isEmpty():
            carried = None
    if not levels:
        return spark.createDataFrame([], "word string, n long, near string, near_n long")
    met = spark.read.parquet(*levels).filter("found").selectExpr("if(way, reverse(text), text) as word", "n", "way", "only as id")
    pairs = met.join(words.selectExpr("id", "word as near", "n as near_n"), "id")
    # the reversed trie also meets the pairs with the same first half, which the other one has found
    again = "way and left(word, cast(length(word) / 2 as int)) = left(near, cast(length(word) / 2 as int))"
    return pairs.filter(f"not ({again}) and levenshtein(word, near, 1) = 1").select("word", "n", "near", "near_n")


def forms(words: DataFrame, near: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """Rows (word, form, n, n_near, form_n) for every word: its most frequent neighbour if frequent enough."""
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    return words.join(best, "word", "left").select(
        "word", F.when(enough, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("best.less")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """Rows (word, root) for the words that have a form: the last word of the chain of forms, by pointer doubling.

    A form is at least `FORM_RATIO` times as frequent, so chains are short and never run in circles.
    """
    at = materialized(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = materialized(at.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if new.filter("moved").isEmpty():
            return new.select("word", "root")
        at = new.select("word", "root")


def group_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_letters: int = LEAST_LETTERS,
                   least_count: int = LEAST_COUNT, ratio: int = FORM_RATIO) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = materialized(count_words(docs, id_column, text_column, least_letters, least_count), "spelling-counts")
    table = materialized(forms(words, neighbours(words), ratio), "spelling-forms")
    ends = roots(table.filter("form is not null"))
    return table.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
