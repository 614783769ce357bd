"""Inputs made to break the operators: colliding strings, shared ids, repeated rows, clashing columns."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from .test_operators import WORD, _components, table


def thue_morse(n: int, flip: bool = False) -> str:
    """A string and its complement collide under any polynomial hash modulo 2**64 once they are long."""
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048])
def test_thue_morse_strings_are_told_apart(spark, n):
    from cartwheel.llm.lines import drop_repeated_lines
    from cartwheel.llm.minhash import near_documents
    from cartwheel.llm.quality import quality_scores
    from cartwheel.llm.substring import remove_repeats

    a, b = thue_morse(n), thue_morse(n, True)
    lines = table(spark, [f"{a}\n{b}", f"{a}\n{b}\n{a}"], lang=["en", "en"])
    assert {r.doc_id: r.n_dup_lines for r in quality_scores(lines).collect()} == {0: 0, 1: 1}
    pair = table(spark, [f"{a} {a} {a} x", f"{b} {b} {b} x"])
    assert [r.component_id for r in near_documents(pair, shingle=4).orderBy("doc_id").collect()] == [0, 1]
    # Runs of the two are strings of each other's: brute force tells which bytes repeat.
    texts = [a, b, a[:300]]
    seen = collections.Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    for r in remove_repeats(table(spark, texts), gram=32).collect():
        gone = bytearray(len(texts[r.doc_id]))
        for i in range(len(texts[r.doc_id]) - 199):
            if seen[texts[r.doc_id][i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        assert r.n_removed == sum(gone)
    docs = table(spark, [f"{a}\nmid\nend one", f"{b}\nmid\nend two"])
    assert {r.doc_id: r.text for r in drop_repeated_lines(docs).collect()} == {0: f"{a}\nmid\nend one", 1: f"{b}\nmid\nend two"}


def test_spans_hash_apart_and_alike():
    from cartwheel.llm.textkernel import prefix_hash, span_hash

    rng = np.random.default_rng(1)
    text = rng.integers(0, 4, 5000).astype(np.uint8)
    start = rng.integers(0, 4900, 3000)
    size = rng.integers(0, 12, 3000)
    for which in (0, 1):
        h = span_hash(prefix_hash(text, which), start, start + size, which)
        spans = [text[s : s + k].tobytes() for s, k in zip(start, size, strict=True)]
        assert len(set(zip(spans, h.tolist(), strict=True))) == len(set(spans)) == len(set(h.tolist()))
    long = np.concatenate([text] * 900)  # over one block of sums
    p = prefix_hash(long)
    at = np.arange(0, len(long) - 5000, 5000)
    assert len(set(span_hash(p, at + 7, at + 4000).tolist())) == 1


def test_op2_long_digit_runs_and_brute_force_columns(spark, tmp_path):
    from cartwheel.llm.pii import KINDS, base_spans
    from cartwheel.llm.registry import QUERIES

    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card = re.compile(r"[0-9]([\x20-]?[0-9])+")
    phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def luhn(d):
        return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0

    def brute(t):
        digits = lambda m: [int(c) for c in m[0] if c in "0123456789"]
        out = [("email", *m.span()) for m in email.finditer(t)]
        out += [("ip", *m.span()) for m in ip.finditer(t) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        out += [("card", *m.span()) for m in card.finditer(t) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
        out += [("phone", *m.span()) for m in phone.finditer(t) if 10 <= len(digits(m)) <= 15]
        return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))

    rng = random.Random(22)
    parts = ["a@b.c", "x.y@z", "@", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "5500-0000-0000-0004", "4111111111111112", "+1 (743) 555-3824", "+12", " ", "é", ".", "0", "007", "\n", "-", "token = ", "9" * 15]
    texts = [None, "", "0" * 5000 + ".1.1.1", "1" * 5000 + ".1.1.1", "0" * 9000 + "12.0" + "0" * 9000 + ".1.1", "+" + "1" * 9000]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(800)]
    assert all(base_spans(t or "") == brute(t or "") for t in texts)
    docs = table(spark, texts).withColumn("spans", F.lit("clash"))
    docs.unionByName(docs.filter("doc_id < 9")).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op2_personal_data"](spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) + 9
    for r in rows:
        want = brute(texts[r.doc_id] or "")
        n = collections.Counter(s[0] for s in want)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in KINDS)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(",")) and r.spans.count(":") == 2 * (len(want) + r.n_added)


def test_op2_secrets_held_out_and_hashes_left_alone(spark):
    from cartwheel.llm.pii import CRF, find_personal_data, labelled_table

    model = CRF.fit(labelled_table())
    rng = random.Random(71)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    words = "Thoréa undiol la quenno Sterha para voilà mit".split()
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts, secrets = [], []
    for i in range(300):
        value = rng.choice([hexa(40), hexa(32), hexa(64), "ghp_" + hexa(30) + "7"])
        sign, quote = rng.choice([" = ", ": ", "=", " := "]), rng.choice(['"', "'", ""])
        head = prose(rng.randint(1, 9)) + " " + rng.choice(["token", "API_KEY", "client_secret", "password", "my_access_key"]) + sign + quote
        texts.append(head + value + quote + rng.choice([" ", "### ", ".\n", ", "]) + prose(rng.randint(0, 9)))
        secrets.append((len(head), len(head) + len(value)))
    clean = [prose(9) + rng.choice([" commit ", " sha256: ", " ", " md5 = "]) + hexa(40) + " " + prose(9) for _ in range(200)]
    clean += [prose(20) + f" {rng.randrange(9999)} {rng.randrange(99)}.{rng.randrange(99)} " + prose(20) for _ in range(200)]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.added] for r in find_personal_data(table(spark, texts + clean), model).collect()}
    caught = sum(("secret", *s) in got[i] for i, s in enumerate(secrets))
    wrong = sum(bool(got[len(texts) + i]) for i in range(len(clean)))
    assert caught >= 0.9 * len(texts) and wrong <= 0.03 * len(clean)


def test_op6_rows_that_share_an_id(spark):
    from cartwheel.llm.vectors import near_vectors

    rng = np.random.default_rng(61)
    base = rng.standard_normal((6, 16))
    rows = [(int(i % 40), [float(x) for x in base[i % 6] + rng.standard_normal(16) * rng.choice([0, 0.02, 0.2])], f"label {i % 2}") for i in range(240)]
    rows += [rows[0]] * 5
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").withColumn("n_links", F.lit("clash"))).collect()
    m = np.array([r[1] for r in rows])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (m @ m.T >= 0.98) & (label[:, None] == label) & ~np.eye(len(rows), dtype=bool)
    low = _components(range(len(rows)), zip(*map(list, np.nonzero(near)), strict=True))
    least = collections.defaultdict(lambda: 10**9)
    for i, c in low.items():
        least[c] = min(least[c], rows[i][0])
    want = sorted((r[0], int(near[i].sum()), least[low[i]], r[0] == least[low[i]]) for i, r in enumerate(rows))
    assert sorted(map(tuple, got)) == want


def test_op8_repeated_rows_cost_no_pairs(spark):
    from cartwheel.llm.lines import drop_repeated_lines

    text = "\n".join(f"line {k} of it" for k in range(8))
    docs = table(spark, ["before\n" + text, "start\n" + text + "\nend"])
    many = docs.crossJoin(spark.range(3000).select(F.lit("x").alias("seq"))).filter("doc_id = 1")
    got = drop_repeated_lines(docs.withColumn("seq", F.lit("x")).filter("doc_id = 0").unionByName(many)).collect()
    assert len(got) == 3001 and {(r.doc_id, r.text) for r in got} == {(0, "before\n" + text), (1, "start\nend")}


def test_op9_repeated_rows_are_spread(spark):
    from cartwheel.llm.sharding import shard_documents

    text = "copy of one row " * 60
    docs = spark.createDataFrame([(7, text)] * 400 + [(i, f"t{i}") for i in range(300)] + [(None, None)] * 20, "doc_id long, text string")
    rows = shard_documents(docs.withColumn("shard", F.lit("clash"))).collect()
    loads, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(rows) == 720 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(loads) == 8 and max(loads.values()) < 1.25 * min(loads.values())


def test_op9_places_every_item_where_the_product_is_highest():
    from cartwheel.llm.sharding import place

    rng = np.random.default_rng(9)
    items = [(f"i{k}", [int(x) for x in rng.integers(1, 100, 3)]) for k in range(200)]
    share = np.array([v for _, v in items], float).sum(axis=0) / 5
    got = place(items, 5, share)
    left = [np.ones(3) for _ in range(5)]
    for name, v in sorted(items, key=lambda x: (-x[1][0], x[0])):
        u = np.array(v) / share
        able = [s for s in range(5) if left[s][0] >= u[0]]
        best = max(able, key=lambda s: (sum(left[s] * u), -s)) if able else max(range(5), key=lambda s: (left[s][0], -s))
        assert got[name] == best
        left[best] = left[best] - u


def test_op10_repeated_ids_and_rows(spark):
    from cartwheel.llm.minhash import near_documents

    rng = random.Random(101)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for k in range(300):  # all under three ids
        words = list(base) if k % 3 else [f"{k}-{i}" for i in range(30)]
        for j in rng.sample(range(len(words)), k % 4):
            words[j] = f"v{k}-{j}"
        rows.append((k % 3, " ".join(words)))
    rows += [rows[1]] * 20 + [(1, None), (None, rows[1][1]), (2, " \n")]
    got = near_documents(spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("clash")), shingle=4).collect()

    def shingles(t):
        w = WORD.findall((t or "").lower())
        return frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()

    sets = [shingles(t) if d is not None else frozenset() for d, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    low = _components(range(len(rows)), links)
    least = {}
    for i, c in low.items():
        if rows[i][0] is not None and sets[i]:
            least[c] = min(least.get(c, 10**9), rows[i][0])
    want = collections.Counter((d, len(shingles(t)), least.get(low[i], d) if sets[i] else d) for i, (d, t) in enumerate(rows))
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_op1_fills_the_gap_beside_a_long_document(spark):
    from cartwheel.llm.mixing import mix

    texts = ["w " * 6000] + ["w " * 10] * 700 + ["v " * 10000]
    docs = table(spark, texts, source=["a"] * 701 + ["b"]).withColumn("mix", F.lit("clash")).withColumn("size", F.lit("clash"))
    rows = mix(docs.drop("mix"), F.array("source"), weights={"a": 1.0, "b": 1.0}, total=8000).select("source", "mix.*").collect()
    taken = collections.Counter()
    for r in rows:
        taken[r.source] += r.taken
    assert abs(taken["a"] - 4000) <= 10


def test_op1_routes_thousands_of_patterns_at_least_cost():
    import time

    from cartwheel.llm.mixing import route

    rng = random.Random(1)
    patterns = [(rng.randint(1, 50), sorted(rng.sample(range(30), rng.randint(1, 3)))) for _ in range(10_000)]
    words = sum(w for w, _ in patterns)
    quotas = [words // 30 + rng.randint(-5000, 5000) for _ in range(30)]
    begin = time.perf_counter()
    flow = route(patterns, quotas)
    assert time.perf_counter() - begin < 30
    assert all(sum(f) <= 3 * w and all(x == 0 or s in m for s, x in enumerate(f)) for f, (w, m) in zip(flow, patterns, strict=True))
    assert all(sum(f[s] for f in flow) <= q for s, q in enumerate(quotas))
    # Small cases against every split, by cost.
    for seed in range(40):
        rng = random.Random(seed)
        small = [(rng.randint(1, 3), sorted(rng.sample(range(2), rng.randint(1, 2)))) for _ in range(3)]
        want = [rng.randint(0, 6) for _ in range(2)]
        best = None

        def walk(k, left, cost, total, small=small):
            nonlocal best
            if k == len(small):
                if best is None or (-total, cost) < best:
                    best = (-total, cost)
                return
            w, m = small[k]
            for x in range(3 * w + 1 if 0 in m else 1):
                for y in range(3 * w + 1 - x if 1 in m else 1):
                    if x <= left[0] and y <= left[1]:
                        walk(k + 1, (left[0] - x, left[1] - y), cost + sum(i // w for i in range(x + y)), total + x + y)

        walk(0, tuple(want), 0, 0)
        got = route(small, want)
        assert best == (-sum(map(sum, got)), sum(i // w for (w, _), f in zip(small, got, strict=True) for i in range(sum(f))))


def test_op4_null_languages_are_judged_by_the_whole_corpus(spark):
    from cartwheel.llm.quality import quality_scores

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    named = {r.doc_id for r in quality_scores(docs).filter("kept").collect()}
    none = {r.doc_id for r in quality_scores(docs.withColumn("lang", F.lit(None).cast("string"))).filter("kept").collect()}
    assert abs(len(none) - len(named)) <= 0.01 * len(named) and len(none & named) >= 0.98 * len(named)


def test_op4_distances_and_fences_match_plain_python(spark):
    import math

    from cartwheel.llm.quality import COMMON_WORDS, FENCE, LEAST_MARGIN, MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE, quality_scores

    rng = random.Random(44)
    vocabulary = ["the", "of", "Ünd,", "x1", "la", "Mot!", "sur", "voilà.", "zu", "|", "#tag", "(A)", "2020", "that;"]
    texts = [" ".join(rng.choice(vocabulary) + rng.choice(["", str(rng.randrange(99))]) for _ in range(rng.randint(5, 300))) for _ in range(150)]
    langs = [rng.choice(["en", "fr", "xx" if i < 9 else "en", None]) for i in range(150)]
    got = {r.doc_id: r for r in quality_scores(table(spark, texts, lang=langs)).collect()}

    def chars(t):
        n = collections.Counter()
        for c in t:
            if c == "!" or c == "|":
                n[c] += 1
            elif "a" <= c <= "z" or "A" <= c <= "Z":
                n["low" if c.islower() else "up"] += 1
            elif c in "0123456789":
                n["digit"] += 1
            elif c in " \t\n\x0b\x0c\r":
                n["space"] += 1
            elif c in ".,;:?'\"-()":
                n["mark"] += 1
            elif c in "[#*$%&<>]{}=+/\\^_~@`":
                n["symbol"] += 1
            elif ord(c) > 127:
                n["wide"] += 1
            else:
                n["other"] += 1
        return n

    def common(t):
        n = collections.Counter()
        for w in WORD.findall(t):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            w = w[:-1] if len(w) > 1 and w[-1] in ".,;:!?" else w
            n[w if w in COMMON_WORDS else None] += 1
        return n

    def js(p, q):
        a, b = sum(p.values()), sum(q.values())
        total = 0.0
        for k in set(p) | set(q):
            x, y = p[k] / a, q[k] / b
            m = (x + y) / 2
            total += (x * math.log2(x / m) if x else 0) / 2 + (y * math.log2(y / m) if y else 0) / 2
        return math.sqrt(max(total, 0))

    ok = [d for d in range(150) if not got[d].base_failed]
    by = collections.defaultdict(list)
    for d in ok:
        by[langs[d]].append(d)
    owner = {d: langs[d] if langs[d] is not None and len(by[langs[d]]) >= 20 else None for d in range(150)}
    total = lambda f, ds: sum((f(texts[d]) for d in ds), collections.Counter())
    refs = {g: (total(chars, ok if g is None else by[g]), total(common, ok if g is None else by[g])) for g in set(owner.values())}
    words = lambda n: collections.Counter({k: v for k, v in n.items() if k is not None})
    want = {}
    for d in range(150):
        if len(WORD.findall(texts[d])) < 50:
            assert got[d].char_distance is None
            continue
        c, w = refs[owner[d]]
        own = common(texts[d])
        want[d] = (js(chars(texts[d]), c), js(own, w), js(words(own), words(w)) if words(own) else 1.0)
        assert np.allclose(want[d], (got[d].char_distance, got[d].word_distance, got[d].function_distance), atol=1e-9)

    def quartiles(x):
        x = sorted(round(v, 3) for v in x)
        at = lambda q: np.interp(q * (len(x) - 1), range(len(x)), x)
        return at(0.25), at(0.75)

    limits = collections.defaultdict(dict)
    for g in refs:
        judged = [d for d in ok if owner[d] == g and d in want]
        for band in {-1} | {int(math.log2(got[d].n_words)) for d in judged}:
            own = [d for d in judged if band in (-1, int(math.log2(got[d].n_words)))]
            if len(own) >= 20:
                limits[g][band] = [q3 + max(FENCE * (q3 - q1), LEAST_MARGIN) for q1, q3 in (quartiles([want[d][k] for d in own]) for k in range(3))]
    for d in range(150):
        bands = [b for b in limits[owner[d]] if b <= int(math.log2(got[d].n_words))]
        fence = limits[owner[d]][max(bands)] if bands else [9.0] * 3
        far = d in want and any(x > min(f, c) for x, f, c in zip(want[d], fence, (MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE, 1.0), strict=True))
        assert got[d].kept == (not got[d].base_failed and not far)


def test_op5_null_ids_and_clashing_columns(spark):
    from cartwheel.llm.chat import format_chats, read_chats

    rows = [(None, 1, "user", "a"), (None, 0, "assistant", "b"), (3, None, None, None), (3, 2, "assistant", "x" * 50_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash")).withColumn("t", F.lit(1))
    got = {r.conv_id: r for r in read_chats(format_chats(turns)).collect()}
    assert [tuple(t) for t in got[None].turns] == [("assistant", "b"), ("user", "a")] and got[3].loss_texts == ["x" * 50_000]


def test_op3_registered_parameters_match_brute_force(spark, tmp_path):
    from cartwheel.llm.registry import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + [(0, "clash" * 100), (0, "clash" * 100), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = collections.Counter(b[i : i + 200] for _, b in raw for i in range(len(b) - 199))
    want = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        want.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    got = QUERIES["op3_substring_dedup"](spark, str(tmp_path)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)


