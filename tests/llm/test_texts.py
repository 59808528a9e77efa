import base64
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import tiktoken
from pyspark.sql import functions as F

from lociflow.llm.mixing import MixPlan, mix_report, mixed_documents
from lociflow.llm.queries import QUERIES
from lociflow.llm.spam import MOST_WORDS, SpamModel, WordIds, _most_frequent, _neighbours, _repeats, find_spam, pair_counts, spam_signs, text_signs, tokenised, word_ids
from lociflow.llm.tokens import PRETOKENS, TOKENIZERS, decode_ids, encode_documents, token_counts
from tests.conftest import SMALL

ODD = [None, "", " ", "\n\n  x", "<|endoftext|> is text", "naïve  café\t\r\n", "日本語のテキスト 🎉🎉", "a" * 30_000, "\u0000▁ ▁ end ", "don't WON'T 12345678", "﻿BOM"]


@pytest.fixture(scope="module")
def public():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(f"{TOKENIZERS}/byte_bpe_50k.tiktoken", "rb"))}
    return tiktoken.Encoding("own", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_public_tokenizer(spark, public):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()] + ODD
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = encode_documents(df)
    out = {r.doc_id: r.ids for r in encoded.collect()}
    assert len(out) == len(texts) and all(out[i] == (public.encode_ordinary(t) if t else []) for i, t in enumerate(texts))
    assert all((texts[r.doc_id] or "") == r.text for r in decode_ids(encoded).collect())
    counts = token_counts(df, keep=())
    assert all(r.n_tokens == len(out[r.doc_id]) for r in counts.collect())


def test_mix_reaches_shares(spark):
    rows = [(i, "big", "word " * 20) for i in range(6000)] + [(10000 + i, "small", "other " * 20) for i in range(1000)] + [(20000 + i, "tiny", "x") for i in range(3)] + [(30000, "unasked", "text"), (30001, "big", None), (30002, "small", ""), (30003, None, "t")]
    docs = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, source string, text string, extra string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 4), ("tiny", 0.05, 2), ("absent", 0.05, 3)], "source string, target_share double, max_repeats int")
    copies, report = mixed_documents(docs, targets), mix_report(docs, targets)
    shares = {r.source: r for r in report.collect()}
    assert shares["absent"].status == "no_documents" and shares["tiny"].status == "capped" and shares["tiny"].most_copies == 2
    assert shares["big"].actual_share / shares["small"].actual_share == pytest.approx(1.25, rel=0.1)
    used = copies.groupBy("doc_id", "source").count().collect()
    assert all(r["count"] <= {"big": 1, "small": 4, "tiny": 2}[r.source] for r in used)
    assert sum(r.tokens_used for r in shares.values()) == copies.agg({"n_tokens": "sum"}).first()[0]
    again = mixed_documents(docs, targets, MixPlan())
    assert again.exceptAll(copies).count() == 0 and copies.exceptAll(again).count() == 0
    half = mix_report(docs, targets, MixPlan(total_tokens=1000.0)).collect()
    assert sum(r.rate * r.tokens_available for r in half) == pytest.approx(1000 * sum(r.target_share for r in half if r.tokens_available), rel=0.1)
    assert mixed_documents(docs.where("false"), targets).count() == 0


def _speech(rng, n: int) -> list[str]:
    """Texts of sentences from a few frames, as speech repeats its turns of phrase."""
    things = ["house", "window", "letter", "garden", "kitchen", "bridge", "boat", "mirror", "ticket", "violin"]
    frames = ["I never wanted to open the {} again", "do you remember the {} by the river", "where did you leave my {} last night", "they found your {} behind the old {}", "we have to sell the {} before it is too late"]
    line = lambda: rng.choice(frames).replace("{}", rng.choice(things), 1).replace("{}", rng.choice(things))
    return ["\n".join(f"{i}\n00:00:{i:02d},000 --> 00:00:{i:02d},900\n{line()}." for i in range(1, 16)) for _ in range(n)]


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(11)
    keys = [f"{a} {b}" for a in ("cheap", "best", "free", "online") for b in ("watches", "casino", "loans", "tickets", "shoes")]
    name = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    words = [" ".join(rng.choice(keys) for _ in range(60)) for _ in range(6)]
    links = ["\n".join(f"http://www.{name()}.example/{name()}/{name()}" for _ in range(40)) for _ in range(6)]
    tags = ["\n".join(f"SKU {rng.randrange(99999)} {rng.choice(['Retro', 'Slim'])} {name()} EUR {rng.randrange(99)}.99" for _ in range(30)) for _ in range(6)]
    return _speech(rng, 400), words, links, tags


def test_spam(spark, pages):
    speech, *spam = pages
    kinds = [t for kind in spam for t in kind]
    song = "\n".join(["♪ do you remember the boat by the river ♪", "♪ la la la la ♪"] * 12)
    odd = [None, "", " \n ", "12\n13", song, "x" * 200_000, "word " * 50_000]
    texts = speech + kinds + kinds[:2] + odd
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, extra string")
    wanted = set(range(len(speech), len(speech) + len(kinds) + 2))
    assert {r.doc_id for r in find_spam(df).collect()} == wanted
    signs = {r.doc_id: r for r in spam_signs(df).collect()}
    assert len(signs) == len(texts)
    empty = signs[len(speech) + len(kinds) + 2]
    assert empty.n_pairs == 0 and empty.pmi is None and not empty.spam
    assert max(signs[i].incoherent for i in range(len(speech))) < 0.3 < min(signs[i].incoherent for i in wanted)
    # the size of the table held by every task changes nothing
    few = {r.doc_id: r for r in spam_signs(df, SpamModel(frequent=5)).collect()}
    assert all(few[i].spam == r.spam and few[i].incoherent == pytest.approx(r.incoherent) for i, r in signs.items())
    assert find_spam(df.where("false")).count() == 0


def test_spam_with_many_copies(spark, pages):
    speech, words, *_ = pages
    texts = speech + words + words[:1] * 200
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in find_spam(df).collect()} == set(range(len(speech), len(texts)))


def test_words_of_damaged_texts():
    ids = WordIds()
    same = lambda a, b: word_ids(a, ids)[0] == word_ids(b, ids)[0]
    assert same("Où est ma clé", "Ou est ma cle") and same("modern", "modem") and same("online", "0n1ine")
    assert same("Сколько стоит", "Сколько стоит".encode("cp1251").decode("latin-1")) and same("être prêt à", "être prêt à".encode().decode("latin-1"))
    assert word_ids("\ufffd\ufffd\ufffd\ufffd", ids)[1] == 4


def test_every_query_runs(spark):
    for name in ("p3_matches", "p8_mix", "p8_shares", "p9_scores", "p7_counts", "p1_quality"):
        assert QUERIES[name](spark, SMALL).count() > 0


class _Caught(Exception):
    """Carries the function that a plan gives to its tasks."""


class _Texts:
    def __init__(self, spark):
        self.sparkSession = spark

    def select(self, *_):
        return self

    def mapInArrow(self, function, _):
        raise _Caught(function)


def _task(plan):
    with pytest.raises(_Caught) as caught:
        plan()
    return caught.value.args[0]


def _peak_mb(task, batch, read) -> tuple[float, list]:
    """MB that the task holds at most, and what ``read`` takes from each batch it gives."""
    tracemalloc.start()
    taken = [read(out) for out in task(iter([batch]))]
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return most, taken


def test_memory_of_spam_tasks_is_bounded(spark):
    rng, texts = np.random.default_rng(3), 4000
    flat = (rng.integers(1, 1 << 40, texts * 500) << 5) | 5
    words = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, 500, dtype=np.int32)), pa.array(flat))
    most, taken = _peak_mb(_task(lambda: pair_counts(_Texts(spark))), pa.RecordBatch.from_arrays([words], ["words"]), lambda b: pc.sum(b.column("n")).as_py())
    assert most < 96 and sum(taken) == texts * 499
    counts = spark.createDataFrame([(1, 1, 1, 0, 1, 1, 1, 1)], "pair long, used long, trusted long, suspected long, left long, right long, any_left long, any_right long")
    look_up = _task(lambda: text_signs(_Texts(spark), counts, SpamModel()))
    ids, zeros, ones = pa.array(np.arange(texts)), pa.array(np.zeros(texts, np.int64)), pa.array(np.ones(texts, np.int64))
    batch = pa.RecordBatch.from_arrays([ids, words, zeros, ones], ["copy_of", "words", "lost", "trusted"])
    most, taken = _peak_mb(look_up, batch, lambda b: (b.column("copy_of").to_pylist(), pc.sum(b.column("n_pairs")).as_py(), len(b.column("rest").flatten())))
    assert most < 96 and [i for ids, _, _ in taken for i in ids] == list(range(texts))
    assert sum(n for _, n, _ in taken) == texts * 499 and max(n for _, _, n in taken) <= MOST_WORDS
    spoken = [None, "", "say it again " * 150_000] + ["where did you leave my letter last night " * 40] * 2000
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(spoken))), pa.array(spoken)], ["doc_id", "text"])
    _, taken = _peak_mb(_task(lambda: tokenised(_Texts(spark), "doc_id", "text")), batch, lambda b: b.column("words").value_lengths().to_pylist())
    assert [n for lengths in taken for n in lengths] == [0, 0, 450_000] + [320] * 2000
    assert sorted(map(sum, taken))[-2] <= 4 * MOST_WORDS


def test_only_words_with_a_neighbour_are_kept(spark):
    text = "\n\n".join(f"{i}\n00:00:{i:02d},000 --> 00:00:{i:02d},900\nwhere is my_letter? ... \n No." for i in range(10, 30))
    rows = {r.doc_id: r for r in tokenised(spark.createDataFrame([(1, text), (2, "Yes.\n\n \n12\n"), (3, None), (4, "�\ngo on")], "doc_id long, text string"), "doc_id", "text").collect()}
    ids = WordIds()
    # all 20 cues; "no" and the numbers of the cues have no neighbour, an underscore parts no sentence
    assert rows[1].words == [*[ids[w] for w in ("where", "is", "my", "letter")], 0] * 20
    assert rows[2].words == rows[3].words == [] and rows[4].words == [ids["go"], ids["on"]]
    assert len({r.copy_of for r in rows.values()}) == 4


def test_pairs_of_a_run_by_brute_force():
    rng = random.Random(5)
    words = [[rng.choice([0, 1, 2, *(w << 5 | w % 9 + 1 for w in range(1, 12))]) for _ in range(rng.choice([0, 1, 2, 40, 300]))] for _ in range(60)]
    row, a, b, times, letters, left, right = _neighbours(pa.array(words, pa.list_(pa.int64())))
    want = Counter((i, x, y) for i, ws in enumerate(words) for x, y in zip(ws, ws[1:]) if x != y and {x, y}.isdisjoint({0, 2}))
    keys = list(zip(row.tolist(), a.tolist(), b.tolist()))
    assert len(set(keys)) == len(keys) and dict(zip(keys, times.tolist())) == want
    assert letters.tolist() == [want[i, x, y] * (x % 32 + y % 32) for i, x, y in keys]
    firsts, seconds = Counter((i, x) for i, x, _ in want), Counter((i, y) for i, _, y in want)
    assert _repeats(left).tolist() == [firsts[i, x] for i, x, _ in keys]
    order = np.argsort(right)
    assert _repeats(right[order]).tolist() == [seconds[keys[k][0], keys[k][2]] for k in order]
    assert all(len(x) == 0 for x in _neighbours(pa.array([[], [0, 1]], pa.list_(pa.int64()))))


def test_most_frequent_pairs_without_a_sort(spark):
    rng = np.random.default_rng(8)
    n = np.minimum(rng.zipf(1.6, 20_000), 500)
    pairs = rng.integers(0, 1 << 63, len(n))
    table = spark.createDataFrame(list(zip(pairs.tolist(), n.tolist())), "pair long, n long")
    times, sizes = np.unique(n, return_counts=True)
    for most in (0, 7, 3000, 20_000, 1 << 18):
        held = {r.pair for r in table.where(_most_frequent(F.col("n"), times, sizes, most)).collect()}
        assert abs(len(held) - min(most, len(n))) < 100
        rest = [k for p, k in zip(pairs.tolist(), n.tolist()) if p not in held]
        assert max(rest, default=0) <= min([k for p, k in zip(pairs.tolist(), n.tolist()) if p in held], default=500)
        assert max(rest, default=0) * most <= n.sum()
