"""Spelling variants, importance resampling and SentencePiece ids against brute force."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from .test_operators import corpus, table


# --- op11 -------------------------------------------------------------------------------------


def _near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _variants(n: dict[str, int]) -> dict[str, tuple]:
    near = {w: [] for w in n}
    for a, b in itertools.combinations(n, 2):
        if abs(len(a) - len(b)) < 2 and _near(a, b):
            near[a].append(b)
            near[b].append(a)
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if n[b] >= 5 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (n[w], len(near[w]), form.get(w), n[form[w]] if w in form else None, root(w)) for w in n}


@pytest.mark.parametrize("part", [4096, 3])
def test_op11_matches_brute_force(spark, part):
    from cartwheel.llm.spelling import spelling_variants

    rng = random.Random(part)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(0, 8))) for _ in range(900)}
    words |= {"x" * 300 + w + "y" * 300 for w in ("", "a", "b", "ab", "aa", "x", "y")} | {"日本語", "日本", "日語", "😀a", "😀"}
    n = {w: rng.choice([1, 2, 5, 9, 30, 160, 900]) for w in words}
    rows = [(w, k) for w, k in n.items()] + [(None, 9), ("lost", None)]
    once = rows[0]
    rows[0] = (once[0], once[1] - 1)
    rows.append((once[0], 1))  # a repeated word adds up
    got = spelling_variants(spark.createDataFrame(rows, "word string, n long"), part=part).collect()
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == _variants(n) and len(got) == len(n)


def test_op11_acceptor_is_minimal_and_numbers_its_strings():
    from cartwheel.llm.spelling import Acceptor

    rng = random.Random(1)
    acceptor = Acceptor()
    sets = [sorted({"".join(rng.choice("abc") for _ in range(4)) for _ in range(k)}) for k in (1, 5, 40, 200)]
    starts = [acceptor.add(s) for s in sets]
    rights = {}

    def language(q):
        if q not in rights:
            rights[q] = frozenset([""] * acceptor.final[q]) | frozenset(c + w for c, (to, _) in acceptor.arcs[q].items() for w in language(to))
        return rights[q]

    assert [sorted(language(q)) for q in starts] == sets
    assert len(set(rights.values())) == len(rights)  # no two states accept the same
    for q, s in zip(starts, sets, strict=True):
        assert sorted(tuple(sorted((s[i], s[j]))) for i, j in acceptor.replaced(q)) == sorted((a, b) for a, b in itertools.combinations(s, 2) if _near(a, b))


def test_op11_query_matches_brute_force(spark, tmp_path):
    from cartwheel.llm.registry import QUERIES

    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeéÿ×") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    texts = [None, "", "1 2 3", "abcdef" * 5000]
    for _ in range(1500):
        words = [rng.choice(vocabulary[: rng.choice([5, 60])]) for _ in range(rng.randint(1, 60))]
        texts.append(rng.choice([" ", "-", "\n", "1"]).join(w.upper() if rng.random() < 0.2 else w for w in words))
    docs = table(spark, texts)
    docs.unionByName(docs.filter("doc_id < 50")).withColumn("word", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    n = collections.Counter()
    for d, t in [*enumerate(texts), *enumerate(texts[:50])]:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{d}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    got = QUERIES["op11_spelling"](spark, str(tmp_path)).collect()
    want = _variants(n)
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == want and sum(v[2] is not None for v in want.values()) > 2


# --- op12 -------------------------------------------------------------------------------------

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text):
    w = TOKEN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def test_op12_crcs_of_spans():
    from cartwheel.llm.resampling import crc32_of_spans

    rng = np.random.default_rng(1)
    text = rng.integers(0, 256, 30_000).astype(np.uint8)
    size = np.concatenate([rng.integers(0, 60, 500), [0, 1, 4096, 4097, 20_000]])
    start = np.array([rng.integers(0, len(text) - s + 1) for s in size])
    got = crc32_of_spans(text, start, size)
    assert got.tolist() == [zlib.crc32(text[s : s + k].tobytes()) for s, k in zip(start, size, strict=True)]
    assert crc32_of_spans(text, start[:0], size[:0]).tolist() == []


def test_op12_matches_brute_force(spark, tmp_path):
    from cartwheel.llm.registry import QUERIES

    texts = [*corpus(12, 120), "É É\x85x a_b ÀB c \U0001f600", "y" * 9000 + " z " + "Y" * 9000]
    texts += [texts[9]] * 30
    docs = table(spark, texts).withColumn("weight", F.lit("clash")).withColumn("rank", F.lit("clash"))
    docs = docs.unionByName(docs.filter("doc_id = 7").withColumn("doc_id", F.lit(None).cast("long")))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items = [None, "", *corpus(13, 10)]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [*enumerate(texts), (None, texts[7])]
    have, want = collections.Counter(), collections.Counter()
    for _, t in rows:
        have.update(_features(t)[1])
    for t in items:
        want.update(_features(t)[1])
    above, below = sum(have.values()) + 10000, sum(want.values()) + 10000
    expected = []
    for d, t in rows:
        n, features = _features(t)
        weight = sum(math.floor(1000 * math.log((want[b] + 1) * above / ((have[b] + 1) * below))) for b in features)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        expected.append((d, n, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in expected if r[1] >= 20), key=lambda r: (-r[4], r[0] if r[0] is not None else -1))
    rank = {r[0]: i + 1 for i, r in enumerate(able[: 5 * len(able) // 100])}
    got = QUERIES["op12_resampling"](spark, str(tmp_path)).collect()
    assert len(rank) >= 5 and {tuple(r) for r in got} == {(d, k, w, s, rank.get(d)) for d, _, k, w, s in expected} and len(got) == len(rows)


def test_op12_ranks_ties_and_repeated_rows(spark):
    from cartwheel.llm.resampling import importance_resample

    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(i // 4, text) for i in range(400)], "doc_id long, text string")
    rows = importance_resample(docs, spark.createDataFrame([("none",)], "text string")).collect()
    ranks = {r["rank"]: r for r in rows if r["rank"]}
    assert sorted(ranks) == list(range(1, 21))
    order = sorted(((r.score, r.doc_id) for r in rows), key=lambda x: (-x[0], x[1]))
    assert [(ranks[k].score, ranks[k].doc_id) for k in sorted(ranks)] == order[:20]


# --- op13 -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    return path, sentencepiece.SentencePieceProcessor(model_file=path)


def test_op13_agenda_equals_the_library(library):
    from cartwheel.llm.sentencepieces import Vocabulary

    path, processor = library
    with open(path, "rb") as f:
        vocabulary = Vocabulary(f.read())
    rng = random.Random(13)
    parts = ["a", "the", "▁", " ", "  ", "    ", "\n", "\t", "é", "é", "日本", "ß", "😀", "\x00", "�", "s", "ing", "<s>", "</s>", "<unk>", "<0x0A>", "2020", " " * 17, "aaaa", "==", "\r\n", " ", "﻿"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0x4E00, 0x9FFF), rng.randrange(0x1F300, 0x1F700)])) for _ in range(40)) for _ in range(500)]
    texts += ["abcdefgh" * 3000, "x" * 5000, " " * 5000]
    ints = lambda rows: [np.frombuffer(x, np.int32).tolist() for x in rows]
    ids = ints(vocabulary.encode(texts, processor))  # chunks are checked as they are met
    assert ids == processor.encode(texts) and [vocabulary.decode(x) for x in ids] == processor.decode(ids)
    assert ints(vocabulary.encode(texts)) == ids  # from memory
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    assert vocabulary.decode_all(np.array(sum(ids, []), np.int32), offsets).to_pylist() == processor.decode(ids)
    wild = [[rng.randrange(600) for _ in range(rng.randint(0, 12))] for _ in range(3000)]
    wild += [[rng.choice([0, 1, 2, 196, 172, 230, 259, 260, 300, 29871]) for _ in range(rng.randint(0, 6))] for _ in range(3000)]
    assert [vocabulary.decode(x) for x in wild] == processor.decode(wild)


def test_op13_matches_the_library(spark, library, tmp_path):
    from cartwheel.llm.registry import QUERIES

    path, processor = library
    texts = [*corpus(14), "日本 語　テ 😀\x00", "a  b\n\n c", "<s> a </s>"]
    docs = table(spark, texts).withColumn("ids", F.lit("clash"))
    docs.unionByName(docs.filter("doc_id < 9")).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d, t in [*enumerate(texts), *enumerate(texts[:9])]:
        ids = processor.encode(t or "")
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(processor.decode(ids))))
    got = QUERIES["op13_sentencepiece"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    from cartwheel.llm.sentencepieces import encode_documents

    assert encode_documents(docs, path, check="texts").count() == len(texts)


def test_op13_decodes_lists_and_refuses_other_models(spark, library):
    from cartwheel.llm.sentencepieces import Vocabulary, decode_ids

    path, processor = library
    rows = spark.createDataFrame([(1, [259, 260, 300]), (2, None), (3, [])], "k int, ids array<int>")
    assert [r.decoded for r in decode_ids(rows, path).orderBy("k").collect()] == [processor.decode([259, 260, 300]), None, ""]
    with open(path, "rb") as f:
        model = f.read()
    with pytest.raises(ValueError, match="BPE model"):
        Vocabulary(model[:200])
    broken = Vocabulary(model)
    broken.merges = {k: ((1 << 20) - (m >> 20)) << 20 | m & 0xFFFFF for k, m in broken.merges.items()}  # the worst pair first
    broken.pair_entries = np.array([broken.merges[k] for k in broken.pair_keys.tolist()])
    with pytest.raises(ValueError, match="differ"):
        broken.encode(["several words that merge in more than one way"], processor)
