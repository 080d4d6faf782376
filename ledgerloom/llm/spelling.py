"""Groups spelling variants of the words of a corpus through an index of variable-length grams.

The gram dictionary is pruned by frequency: a gram is extended by the next letter only while more than a limit of the
words hold it. A word, between two marks for its ends, is decomposed into the longest dictionary gram at each
position, without those inside another one, and no gram longer than half of the word. One edit affects only the grams
over one position, so of a set of grams at least its size less the largest number of grams over one position stay
(the word's affected-gram bound). The lists that are merged for a word are the two cheapest of its grams that do not
overlap: the bound leaves one of them whole, and the half rule gives every word such a pair. The index holds each word
under every dictionary gram in it with its place and the word's length, so a list holds only words that can match
there; shorter words look for partners that are as long or one longer. Candidates are verified by edit distance.

The result does not depend on the limit. It starts at ``LIMIT`` words and doubles until the frequent grams are at most
``GRAMS``, which bounds what is sent to the tasks.

Defined cases. NULL and empty texts have no words; a NULL id counts as an empty text in the checksum. Repeated rows
count each. A word of one letter is near no other. No words of enough letters and occurrences give no rows. Further columns of the input are not looked at.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import ascii_lower, crc, stored, text_of
from ledgerloom.operators.skew import left_join

# Fixed values of the query contract.
OUTSIDE = "[^a-zÀ-ÿ]+"
DAMAGE, LETTERS, TIMES, RATIO = 97, 5, 3, 2
SHORTEST, LONGEST = 2, 8  # letters of a gram
LIMIT, GRAMS = 256, 200_000
START, END = "\x01", "\x02"


def word_counts(docs: DataFrame, damage: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters with A-Z lowered, of enough letters and occurrences.

    With ``damage``, runs whose checksum with the id it divides lose one letter.
    """
    runs = F.array_remove(F.split(ascii_lower(text_of(text_col)), OUTSIDE), "")
    rows = docs.select(text_of(id_col).alias("id"), F.explode(runs).alias("word"))
    if damage:
        mark = crc(F.concat("id", F.lit(":"), "word"))
        rows = rows.select("word", mark.alias("h")).withColumn("at", (F.col("h") % F.char_length("word")).cast("int"))
        cut = F.concat(F.substr("word", F.lit(1), F.col("at")), F.substr("word", F.col("at") + 2))
        rows = rows.select(F.when(F.col("h") % damage == 0, cut).otherwise(F.col("word")).alias("word"))
    rows = rows.where(F.char_length("word") >= LETTERS)
    return rows.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= TIMES)


def _padded(word: str) -> tuple[str, int]:
    """The word between its marks, and the longest gram it may have."""
    s = START + word + END
    return s, max(SHORTEST, min(LONGEST, len(s) // 2))


def frequent_grams(words: DataFrame, limit: int = LIMIT, most: int = GRAMS) -> dict[str, int]:
    """The grams that more than a limit of the words hold: the inner nodes of the dictionary, ``most`` at most."""

    def run(batches):
        for batch in batches:
            found = []
            for word in batch["word"]:
                s, cap = _padded(word)
                found.extend({s[i:i + q] for q in range(SHORTEST, cap + 1) for i in range(len(s) - q + 1)})
            counts = pd.Series(found, dtype=object).value_counts()
            yield pd.DataFrame({"gram": counts.index, "n": counts.to_numpy()})

    counted = words.select("word").mapInPandas(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counted = stored(counted.where(F.col("n") > limit), "grams")
    steps = counted.groupBy(F.floor(F.log2(F.col("n") / limit)).alias("step")).agg(F.count("*").alias("k")).orderBy(F.desc("step")).collect()  # 64 at most
    total = 0
    for r in steps:
        total += r["k"]
        if total > most:
            limit *= 2 ** (r["step"] + 1)
            break
    return {r["gram"]: r["n"] for r in counted.where(F.col("n") > limit).collect()}


def decompose(word: str, frequent: dict[str, int]) -> list[tuple[int, str]]:
    """(position, gram): the longest dictionary gram at each position that no other gram holds."""
    s, cap = _padded(word)
    grams, reach = [], 0
    for i in range(len(s) - SHORTEST + 1):
        q = SHORTEST
        while q < cap and i + q < len(s) and s[i:i + q] in frequent:
            q += 1
        if i + q > reach:
            grams.append((i, s[i:i + q]))
            reach = i + q
    return grams


def affected(grams: list[tuple[int, str]]) -> int:
    """The most of these grams that one edit of the word can touch: those over one position."""
    return max((sum(i <= p < i + len(g) for i, g in grams) for p in {i for i, _ in grams}), default=0)


def merged_lists(grams: list[tuple[int, str]], frequent: dict[str, int]) -> list[tuple[int, str]]:
    """The two cheapest grams that do not overlap: of them one edit affects one at most."""
    cost = [(frequent.get(g, 0), -len(g)) for _, g in grams]
    pairs = [
        (cost[a][0] + cost[b][0], cost[a][1] + cost[b][1], a, b)
        for a in range(len(grams)) for b in range(a + 1, len(grams)) if grams[a][0] + len(grams[a][1]) <= grams[b][0]
    ]
    return [grams[i] for i in min(pairs)[2:]]


def _entries(words: DataFrame, frequent: dict[str, int], index: bool) -> DataFrame:
    """(key, word, n): the list entries of each word, or the lists that it looks up."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def listed(word: str) -> list[str]:
        (s, cap), grams, keys = _padded(word), shared.value, []
        for i in range(len(s) - SHORTEST + 1):
            q = SHORTEST
            while True:
                keys.append(f"{len(word)}:{i}:{s[i:i + q]}")
                if q >= cap or i + q >= len(s) or s[i:i + q] not in grams:
                    break
                q += 1
        return keys

    def looked(word: str) -> list[str]:
        (i, g), (j, h) = merged_lists(decompose(word, shared.value), shared.value)
        size = len(word)  # one letter replaced: places stay; one letter more: before it they stay, behind it they move
        return [f"{size}:{i}:{g}", f"{size}:{j}:{h}", f"{size + 1}:{i}:{g}", f"{size + 1}:{j + 1}:{h}"]

    keys_of = listed if index else looked

    def run(batches):
        for batch in batches:
            yield batch.assign(keys=[keys_of(w) for w in batch["word"]])

    found = words.select("word", "n").mapInPandas(run, "word string, n long, keys array<string>")
    return found.select(F.explode("keys").alias("k"), "word", "n").select(F.xxhash64("k").alias("key"), "word", "n")


def _merged(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the words. Without the hint Spark may broadcast it: it goes by the size of the stored
    words, while a word makes dozens of exploded keys."""
    return side.hint("merge")


def near_words(words: DataFrame, limit: int = LIMIT, most: int = GRAMS) -> DataFrame:
    """(word, n) -> (word, n, other, other_n): all pairs that differ by one inserted, deleted or replaced letter, both ways round."""
    words = words.where(F.char_length("word") > 1)
    frequent = frequent_grams(words, limit, most)
    lists = _entries(words, frequent, index=True).select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    met = left_join(_entries(words, frequent, index=False), _merged(lists), "key")
    longer = F.char_length("other") > F.char_length("word")
    met = met.where(longer | (F.col("word") < F.col("other"))).where(F.levenshtein("word", "other", 1) == 1)
    pairs = stored(met.select("word", "n", "other", "other_n").distinct(), "near-words")
    back = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return pairs.unionByName(back)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): forms followed to the last, twice as far in each round."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        moved = at.join(_merged(on), at["root"] == on["_at"], "left")
        moved = stored(moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def variants(words: DataFrame, limit: int = LIMIT, most: int = GRAMS) -> DataFrame:
    """(word, n) -> word, form, root, n, n_near, form_n.

    The form is the near word of largest n (of equal ones the first by code point) if that is twice the word's or more.
    """
    words = stored(words, "words")
    best = near_words(words, limit, most).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("form"))).alias("b")
    )
    rows = words.join(_merged(best), "word", "left").withColumn("form_n", -F.col("b")["m"])
    has = F.col("form_n") >= RATIO * F.col("n")
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("b")["form"]).alias("form"), F.when(has, F.col("form_n")).alias("form_n"),
    )
    rows = stored(rows, "forms")
    joined = rows.join(_merged(_roots(rows.where("form IS NOT NULL"))), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
