"""Keyword-stuffed pages and link lists, found by the coherence of neighbouring words.

Every text is tokenised once and the word ids are kept in the shared folder. Each distinct text
counts once for a pair of neighbouring words, however often the pair or the text is repeated.

* Mean PMI. A pair's pointwise mutual information comes from the corpus' counts without the text
  itself. A pair below ``least_pmi``, or seen in no other text, is incoherent: strung-together
  keywords, product tags and pieces of addresses hardly ever follow each other in speech.
* Repeated collocations. A pair that a text uses over and over, far above the corpus' rate.

Spam is common enough that its own pairs look coherent to each other, so PMI is taken twice: first
over all texts, then with the texts that the first round suspects held apart. A pair that is found
more often in suspected than in trusted texts counts as unseen in the second round.

The counts of the ``frequent`` most common pairs (a fixed number) are looked up within the tasks;
all rarer pairs meet their counts in an exact join, where no pair is hot because the hot ones are
in the first table. Nothing is sampled, and thresholds are ratios, so they don't move with size.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.operators.skew import salted_join
from lociflow.session import written


@dataclass(frozen=True)
class SpamModel:
    """Thresholds.

    A pair is incoherent below ``least_pmi``, and over-repeated if a text has it ``repeats`` times
    and ``lift`` times as often as the corpus. The first round suspects a text by any of
    ``suspect_incoherent`` and ``suspect_repeated`` (shares of its letters in such pairs) or a mean
    PMI below ``suspect_pmi`` times the corpus' mean. A text is spam if, in the second round, more than
    ``most_incoherent`` of its letters are in incoherent pairs, or more than ``most_repeated`` in
    over-repeated ones while its mean PMI is below that of speech (songs repeat coherent lines), and
    it has ``least_pairs`` pairs. ``frequent`` is the number of pairs whose
    counts every task holds; it bounds memory and changes no result.
    """

    least_pmi: float = 0.5
    smoothing: float = 0.5
    repeats: int = 3
    lift: float = 60.0
    suspect_incoherent: float = 0.25
    suspect_repeated: float = 0.3
    suspect_pmi: float = 0.6
    most_incoherent: float = 0.5
    most_repeated: float = 0.8
    least_pairs: int = 6
    frequent: int = 1 << 18


# Cleaning and tokens.

# a first digit by itself lets the search skip to digits
_TIME = re.compile(r"\d\d*:\d\d(?::\d\d)?[.,]\d+\s*\S{1,3}\s*\d+:\d\d(?::\d\d)?(?:[.,]\d+)?[^\n]*")
_MARKUP = re.compile(r"\{[^}]*\}|</?(?:i|b|u|font)\b[^>]*>")
#: Words with inner apostrophes, ends of sentences and lines (with the white space after them), and lost characters;
#: for texts without underscores, which are no letters.
_TOKEN = re.compile(r"\w++(?:['’|]\w++)*+|\n\s*+|[.!?…♪]++(?:\s++|$)|�++")
#: What only texts read in a wrong encoding have, besides lost characters: odd pairs, or three accented letters in a row.
_MISREADINGS = tuple(map(re.compile, ("[ÃÂÐÑâ][\u0080-¿€-™]", "[РСГВ][\u0080-¿Ђ-Џђ-џ‐-™]", "[À-ÿ][À-ÿ][À-ÿ]", "в[™„Ђ€]")))
#: What any of these begins with, quicker to search for.
_MAY_MISREAD = re.compile("[ÃÂÐÑâРСГВÀ-ÿв�]")
#: Encodings that texts are wrongly read in: (read as, really).
_ENCODINGS = (
    ("cp1252", "utf-8"), ("latin-1", "utf-8"), ("cp1251", "utf-8"), ("latin-1", "cp1251"), ("cp1252", "cp1251"),
)
#: Characters that character recognition mixes up, as one.
_LOOKALIKE = str.maketrans({"0": "o", "1": "i", "5": "s", "|": "i", "l": "i", "c": "e", "’": "'"})
BREAK, NUMBER, LOST = 0, 1, 2
_LENGTH = 31
MOST_CACHED = 300_000
#: Words that are worked on at once, and pairs that are held to be added up: they bound a task's memory and change no result.
MOST_WORDS, MOST_HELD = 1 << 17, 1 << 18


class WordIds(dict):
    """Word -> id, worked out once a word; forgotten when it grows beyond ``MOST_CACHED``."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MOST_CACHED:
            self.clear()
        if word[0] == "�":
            found = LOST
        elif not word[0].isalnum():
            found = BREAK
        elif word.isdigit():
            found = NUMBER
        else:
            found = _word_id(word)
        self[word] = found
        return found


def _word_id(word: str) -> int:
    """A 63-bit hash of the word without accents and look-alike letters; its low five bits are its length."""
    bare = "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))
    bare = bare.translate(_LOOKALIKE).replace("rn", "m").replace("vv", "w")
    return (xxhash.xxh3_64_intdigest(bare) >> 1) & ~_LENGTH | min(max(len(bare), 1), _LENGTH)


def _misread(text: str) -> bool:
    return "�" in text or any(pattern.search(text) for pattern in _MISREADINGS)


def _reread(line: str) -> str:
    """The line in the encoding it was written in, or only its length as lost characters if that can't be told."""
    tries = [line]
    for _ in range(2):  # some texts were misread twice
        further = []
        for text in tries:
            for wrong, right in _ENCODINGS:
                try:
                    other = text.encode(wrong).decode(right)
                except UnicodeError:
                    continue
                if not _misread(other):
                    return other
                further.append(other)
        tries = further
    return "�" * len(line)


def word_ids(text: str, ids: dict[str, int]) -> tuple[list[int], int]:
    """(ids of the words and breaks in order, number of characters that can't be read)."""
    text = text.replace("﻿", "").replace("\r\n", "\n").replace("\r", "\n")
    text = _MARKUP.sub("", _TIME.sub("\n", text) if ":" in text else text)
    if not text.isascii() and _MAY_MISREAD.search(text) and _misread(text):
        text = "\n".join(_reread(line) if _misread(line) else line for line in text.split("\n"))
    lost = text.count("�")
    return list(map(ids.__getitem__, _TOKEN.findall(text.lower().replace("_", "-")))), lost


def _runs(batches: Iterator[pa.RecordBatch], sizes: Callable[[pa.RecordBatch], pa.Array], most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows into runs of at most ``most`` in size; a larger row is a run of its own."""
    for batch in batches:
        ends = np.cumsum(sizes(batch).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _paired(texts: list[np.ndarray]) -> pa.ListArray:
    """The words of each text that have a neighbour, and one break in place of whatever is between them."""
    flat, lengths = np.concatenate(texts), [len(words) for words in texts]
    row = np.repeat(np.arange(len(texts)), lengths)
    word = (flat != BREAK) & (flat != LOST)
    same = row[1:] == row[:-1]
    pair = word[1:] & word[:-1] & same
    paired = np.zeros(len(flat), bool)
    paired[:-1] |= pair
    paired[1:] |= pair
    kept = paired.copy()
    kept[1:] |= paired[:-1] & same
    ends = np.r_[0, np.cumsum(np.bincount(row[kept], minlength=len(texts)))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.where(paired, flat, BREAK)[kept]))


def tokenised(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, copy_of, words, lost) of every document; texts of the same words share ``copy_of``.

    ``words`` are those with a neighbour, any others between them being one break. Null and blank texts have no words.
    """

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in _runs(batches, lambda batch: pc.coalesce(pc.utf8_length(batch.column(1)), 0), 8 * MOST_WORDS):
            texts, prints, losses = [], [], []
            for value in batch.column(1).to_pylist():
                found, lost = word_ids(value or "", ids)
                words = np.array(found, np.int64)
                texts.append(words)
                prints.append(xxhash.xxh3_64_intdigest(words[words != BREAK].tobytes(), seed=lost) >> 1)
                losses.append(lost)
            columns = [batch.column(0).cast(pa.int64()), pa.array(prints, pa.int64()), _paired(texts), pa.array(losses, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [key, "copy_of", "words", "lost"])

    return documents.select(key, text).mapInArrow(tokenise, f"{key} long, copy_of long, words array<long>, lost long")


# Pairs of neighbours, in numpy within the tasks.


def _neighbours(words: pa.ListArray) -> tuple[np.ndarray, ...]:
    """(row, first word, second word, times, letters, key of row and first word, of row and second) of every distinct pair of each row.

    In the order of the first of these keys. Two numbers, or a word and itself (la la la), tell nothing.
    """
    lengths = words.value_lengths().to_numpy(zero_copy_only=False)
    coded = words.flatten().dictionary_encode()
    flat, code = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    word = ((flat != BREAK) & (flat != LOST))[code]
    at = np.flatnonzero((row[1:] == row[:-1]) & (code[1:] != code[:-1]) & word[1:] & word[:-1])
    bits = len(flat).bit_length()
    # in 63 bits, as a run is of few words or of one row
    key = np.sort((row[at] << bits | code[at]) << bits | code[at + 1])
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    times = np.diff(np.r_[starts, len(key)])
    left, b = key[starts] >> bits, key[starts] & ((1 << bits) - 1)
    row, first, second = left >> bits, flat[left & ((1 << bits) - 1)], flat[b]
    return row, first, second, times, times * ((first & _LENGTH) + (second & _LENGTH)), left, row << bits | b


def pair_id(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 63-bit hash of two word ids in order."""
    x = a.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) ^ (b.astype(np.uint64) >> np.uint64(3)) ^ (b.astype(np.uint64) << np.uint64(61))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) >> np.uint64(1)).astype(np.int64)


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, a, b, n): in how many texts each pair of neighbours occurs, added up within the tasks first."""

    def added(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        pair, a, b, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        starts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]][: len(pair)])
        first = order[starts]
        return pair[starts], a[first], b[first], np.add.reduceat(n[order], starts) if len(starts) else n

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_batch = lambda sums: pa.RecordBatch.from_arrays([pa.array(x) for x in sums], ["pair", "a", "b", "n"])
        held, size = [], 0
        for batch in _runs(batches, lambda batch: batch.column(0).value_lengths(), MOST_WORDS):
            _, a, b, *_ = _neighbours(batch.column(0))
            held.append((pair_id(a, b), a, b, np.ones(len(a), np.int64)))
            size += len(a)
            if size > MOST_HELD:
                held = [added(held)]
                size = len(held[0][0])
                if size > MOST_HELD // 2:
                    yield as_batch(held[0])
                    held, size = [], 0
        if held:
            yield as_batch(added(held))

    counted = texts.select("words").mapInArrow(count, "pair long, a long, b long, n long")
    return counted.groupBy("pair").agg(F.first("a").alias("a"), F.first("b").alias("b"), F.sum("n").alias("n"))


def with_margins(counts: DataFrame) -> DataFrame:
    """(pair, trusted, suspected, used, left, right, any_left, any_right).

    ``left`` and ``right`` add up ``used`` over all pairs with the same first or second word, the
    ``any_`` columns the texts of either kind. Pairs found more often in suspected than in trusted
    texts have ``used`` 0.
    """
    counted = counts.withColumn("used", F.when(F.col("trusted") >= F.col("suspected"), F.col("trusted")).otherwise(0))
    either = F.sum(F.col("trusted") + F.col("suspected"))
    left = counted.groupBy("a").agg(F.sum("used").alias("left"), either.alias("any_left"))
    right = counted.groupBy("b").agg(F.sum("used").alias("right"), either.alias("any_right"))
    # one row a word meets its distinct pairs, of which there are no more than words, so no key is too hot for a task
    wide = counted.join(left.hint("shuffle_hash"), "a").join(right.hint("shuffle_hash"), "b")
    return wide.select("pair", "used", *COUNTS)


COUNTS = ("trusted", "suspected", "left", "right", "any_left", "any_right")
SUMS = ("letters", "incoherent", "repeated", "pmi")


def _signs(model: SpamModel, total, pair, trust, times, size, letters, own_left, own_right):
    """Letters x (informative, incoherent, over-repeated, PMI) of pairs, whose corpus counts exclude their own text."""
    trusted, suspected = pair["trusted"] - trust, pair["suspected"] - (1 - trust)
    seen = np.where(trusted >= suspected, np.maximum(trusted, 0), 0)
    left = np.maximum(pair["left"] - own_left * trust, 0)
    right = np.maximum(pair["right"] - own_right * trust, 0)
    # nothing is known of two words that no other text has
    known = (pair["any_left"] > own_left) | (pair["any_right"] > own_right)
    with np.errstate(divide="ignore"):
        pmi = np.log(seen * total / (np.maximum(left, 1) * np.maximum(right, 1)))
    never = np.minimum(np.log(model.smoothing * total / ((left + 1.0) * (right + 1.0))), 0)
    pmi = np.where(seen > 0, pmi, never)
    lift = times / size * total / (seen + model.smoothing)
    repeated = (times >= model.repeats) & (lift > model.lift)
    weight = letters * known
    return weight, weight * (pmi < model.least_pmi), letters * repeated, weight * pmi


def _most_frequent(n: Column, times: np.ndarray, pairs: np.ndarray, most: int) -> Column:
    """Whether a pair that ``n`` texts have is among the (about) ``most`` most frequent, ``pairs`` of which are in so many ``times``.

    Of the pairs at the limit, those with the lowest hashes. No other pair is in more than one in ``most`` of all places.
    """
    order = np.argsort(-times)
    before = np.cumsum(pairs[order]) - pairs[order]
    last = int(np.searchsorted(before + pairs[order], most, "right"))
    if last == len(order):
        return F.lit(True)
    limit, share = int(times[order[last]]), float((most - before[last]) / pairs[order[last]])
    return (n > limit) | ((n == limit) & (F.col("pair") < int(share * (1 << 63))))


def text_signs(texts: DataFrame, counts: DataFrame, model: SpamModel) -> DataFrame:
    """(copy_of, lost, n_pairs, letters, incoherent, repeated, pmi) of every distinct text.

    ``texts``: copy_of, words, lost, trusted (1 or 0); ``counts``: as of ``with_margins``. Sums over
    letters; a text without pairs has zeros.
    """
    spark = texts.sparkSession
    n = F.col("trusted") + F.col("suspected")
    sizes = counts.groupBy(n.alias("n")).agg(F.count("*").alias("pairs"), F.sum("used").alias("used")).toArrow()
    total = float(pc.sum(sizes.column("used")).as_py() or 1)
    frequent = _most_frequent(n, *(sizes.column(c).to_numpy() for c in ("n", "pairs")), model.frequent)
    top = counts.where(frequent).drop("used").toArrow()
    table = {c: np.asarray(top.column(c).to_numpy(), np.int64) for c in ("pair", *COUNTS)}
    order = np.argsort(table["pair"])
    shared = spark.sparkContext.broadcast({c: v[order] for c, v in table.items()})
    rest_type = pa.struct([("pair", pa.int64()), ("times", pa.int64()), ("letters", pa.int64()), ("own_left", pa.int64()), ("own_right", pa.int64())])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in _runs(batches, lambda batch: batch.column(1).value_lengths(), MOST_WORDS):
            rows = batch.num_rows
            trust_of = batch.column(3).to_numpy(zero_copy_only=False)
            row, a, b, times, letters, left, right = _neighbours(batch.column(1))
            size = np.bincount(row, weights=times, minlength=rows)
            order, own_right = np.argsort(right), np.empty(len(right), np.int64)
            own_left, own_right[order] = _repeats(left), _repeats(right[order])
            pair = pair_id(a, b)
            at = np.minimum(np.searchsorted(known["pair"], pair), max(len(known["pair"]) - 1, 0))
            hit = known["pair"][at] == pair if len(known["pair"]) else np.zeros(len(pair), bool)
            found = {c: v[at[hit]] for c, v in known.items()}
            signs = _signs(model, total, found, trust_of[row[hit]], times[hit], size[row[hit]], letters[hit], own_left[hit], own_right[hit])
            sums = [pa.array(np.bincount(row[hit], weights=s, minlength=rows)) for s in signs]
            rest = pa.StructArray.from_arrays([pa.array(x[~hit]) for x in (pair, times, letters, own_left, own_right)], fields=list(rest_type))
            ends = np.r_[0, np.cumsum(np.bincount(row[~hit], minlength=rows))].astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest)
            columns = [batch.column(0), batch.column(2), batch.column(3), pa.array(size.astype(np.int64)), *sums, listed]
            yield pa.RecordBatch.from_arrays(columns, ["copy_of", "lost", "trusted", "n_pairs", *SUMS, "rest"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
            signs = _signs(model, total, c, c["trust"], c["times"], c["n_pairs"], c["letters"], c["own_left"], c["own_right"])
            yield pa.RecordBatch.from_arrays([pa.array(c["copy_of"]), *[pa.array(s.astype(float)) for s in signs]], ["copy_of", *SUMS])

    sums = ", ".join(f"{s} double" for s in SUMS)
    pairs = "array<struct<pair:long,times:long,letters:long,own_left:long,own_right:long>>"
    schema = f"copy_of long, lost long, trusted long, n_pairs long, {sums}, rest {pairs}"
    looked = written(texts.select("copy_of", "words", "lost", "trusted").mapInArrow(look_up, schema))
    rare = looked.select("copy_of", F.col("trusted").alias("trust"), "n_pairs", F.explode("rest").alias("r"))
    # the frequent pairs are out of it, so no pair here is in more than one in ``frequent`` of all places
    met = rare.select("copy_of", "trust", "n_pairs", "r.*").join(counts.where(~frequent).drop("used").hint("shuffle_hash"), "pair")
    judged = met.drop("pair").mapInArrow(judge, f"copy_of long, {sums}")
    parts = looked.drop("rest", "trusted").unionByName(judged, allowMissingColumns=True)
    added = [F.sum(s).alias(s) for s in SUMS]
    return parts.groupBy("copy_of").agg(F.max("lost").alias("lost"), F.max("n_pairs").alias("n_pairs"), *added)


def _repeats(keys: np.ndarray) -> np.ndarray:
    """How often each of the sorted keys occurs."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    runs = np.diff(np.r_[starts, len(keys)])
    return np.repeat(runs, runs)


def shares(signs: DataFrame) -> DataFrame:
    """(copy_of, n_pairs, pmi, incoherent, repeated): the mean PMI and the shares of a text's letters in pairs of each sign.

    What can't be read counts as text without any sign.
    """
    whole = F.col("letters") + 2 * F.col("lost")
    share = {c: F.coalesce(F.try_divide(F.col(c), whole), F.lit(0.0)) for c in ("incoherent", "repeated")}
    mean = F.try_divide(F.col("pmi"), F.col("letters")).alias("pmi")
    return signs.select("copy_of", "n_pairs", mean, *[s.alias(c) for c, s in share.items()])


def spam_signs(documents: DataFrame, model: SpamModel = SpamModel(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document: key, n_pairs, pmi (mean), incoherent, repeated, suspected (in the first round), spam.

    Null, empty and blank texts have no pairs, a null mean and are no spam; copies of a text get
    the same figures; an empty table gives no rows; further columns are ignored.
    """
    tokens = written(tokenised(documents, key, text))
    texts = written(tokens.dropDuplicates(["copy_of"]).select("copy_of", "words", "lost", F.lit(1).cast("long").alias("trusted")))
    every = written(pair_counts(texts))
    plain = written(with_margins(every.withColumns({"trusted": F.col("n"), "suspected": F.lit(0).cast("long")})))
    signs = written(text_signs(texts, plain, model))
    first = shares(signs)
    usual = signs.agg(F.try_divide(F.sum("pmi"), F.sum("letters"))).first()[0] or 0.0
    low = usual * model.suspect_pmi
    doubtful = (F.col("incoherent") > model.suspect_incoherent) | (F.col("repeated") > model.suspect_repeated) | (F.col("pmi") < low)
    suspects = written(first.select("copy_of", F.coalesce(doubtful, F.lit(False)).alias("suspected")).where("suspected"))
    judged = texts.drop("trusted").join(suspects, "copy_of", "left")
    judged = judged.withColumn("trusted", F.when(F.col("suspected"), 0).otherwise(1).cast("long"))
    apart = pair_counts(judged.where("suspected")).select("pair", F.col("n").alias("suspected"))
    both = every.join(apart.hint("shuffle_hash"), "pair", "left").withColumn("suspected", F.coalesce("suspected", F.lit(0)))
    split = written(with_margins(both.withColumn("trusted", F.col("n") - F.col("suspected"))))
    second = shares(text_signs(judged, split, model)).join(suspects, "copy_of", "left")
    strung = (F.col("repeated") > model.most_repeated) & (F.col("pmi") < low)
    spam = (F.col("n_pairs") >= model.least_pairs) & ((F.col("incoherent") > model.most_incoherent) | strung)
    verdict = second.withColumns({"suspected": F.coalesce("suspected", F.lit(False)), "spam": F.coalesce(spam, F.lit(False))})
    # all copies of a text take its verdict: one row a distinct text meets many documents at most
    return salted_join(tokens.select(key, "copy_of"), verdict, "copy_of", F.col(key), salts=4).drop("copy_of")


def find_spam(documents: DataFrame, model: SpamModel = SpamModel(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key of every page that is mostly strung-together keywords, links or product tags."""
    return spam_signs(documents, model, key, text).where("spam").select(key)
