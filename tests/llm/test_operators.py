"""Each operator against a brute-force version, with nulls, empty texts, ties, repeats and empty tables."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, texts, **extra):
    """Documents with a clashing extra column; ``extra`` are lists of strings."""
    rows = [(i, t, "h", *(v[i] for v in extra.values())) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, h string" + "".join(f", {k} string" for k in extra)
    return spark.createDataFrame(rows, schema)


def corpus(seed=1, n=40):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Ünd", "x1", "la", "Mot,", "sur", "voilà", "zu", "den", "ab", "cd"]
    text = lambda k: " ".join(rng.choice(vocabulary) + rng.choice(["", str(rng.randrange(99))]) for _ in range(k))
    passages = [text(rng.randint(20, 70)) for _ in range(6)]
    out = [None, "", " \n\t ", "one", "a" * 900, text(3000)]
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else text(rng.randint(3, 40)) for _ in range(rng.randint(1, 6))]
        out.append(rng.choice(["\n", " ", "\n\n"]).join(parts))
    for t in out[6:20]:  # exact and near copies
        out += [t] * rng.randint(0, 3)
        words = t.split(" ")
        words[rng.randrange(len(words))] = "edited"
        out.append(" ".join(words))
    return out


def test_op3_matches_brute_force(spark):
    from cartwheel.llm.substring import remove_repeats

    texts = corpus()
    raw = [(t or "").encode() for t in texts]
    for length in (200, 40):
        seen = collections.Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
        got = {r.doc_id: r for r in remove_repeats(table(spark, texts), length=length, gram=16).collect()}
        for d, b in enumerate(raw):
            gone = bytearray(len(b))
            for i in range(len(b) - length + 1):
                if seen[b[i : i + length]] > 1:
                    gone[i : i + length] = b"\1" * length
            kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
            assert (got[d].n_bytes, got[d].n_removed, got[d].kept_sha256) == (len(b), sum(gone), hashlib.sha256(kept).hexdigest())
            assert got[d].n_spans == len(re.findall(b"\1+", bytes(gone))) and bytes(got[d].kept) == kept


def test_op4_counts_match_brute_force(spark):
    from cartwheel.llm.quality import quality_scores

    texts = [*corpus(2), "a\n\na\n b\r\na\n", "x y z x y z x y z x y z\n" * 3, "#a $b <c> | %"]
    langs = [random.Random(i).choice(["en", "fr", None]) for i in range(len(texts))]
    got = {r.doc_id: r for r in quality_scores(table(spark, texts, lang=langs)).collect()}
    for d, t in enumerate(texts):
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        again = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again)
        )
        assert r.base_failed == (len(w) < 10 or 100 * len(again) > 20 * len(w)) and (not r.kept or not r.base_failed)


def test_op4_rejects_foreign_text_and_keeps_short(spark):
    from cartwheel.llm.quality import quality_scores

    rng = random.Random(3)
    plain = [" ".join(f"{rng.choice(['the', 'of', 'and'])} {chr(97 + rng.randrange(26)) * 3}{rng.randrange(9)}x" for _ in range(60)) for _ in range(40)]
    shouted = " ".join(f"W{i}!!### $$$%%% &&&*** <<|>>" for i in range(60))
    got = quality_scores(table(spark, [*plain, shouted, "A!! B!! C!! D!! E!! F!! G!! H!! I!! J!! K!!"], lang=["en"] * 42)).collect()
    assert [r.kept for r in sorted(got, key=lambda r: r.doc_id)] == [True] * 40 + [False, True]


def test_op4_rejects_other_language_and_pipe_list_and_keeps_clean(spark):
    from cartwheel.llm.quality import quality_scores

    rng = random.Random(13)
    function = {"en": "the of and to in is that it for with as on".split(), "fr": "le la les de des du et en un une que qui".split()}

    def prose(lang, n):
        return " ".join(rng.choice(function[lang]) if rng.random() < 0.3 else "".join(rng.choice("aeinorst") for _ in range(rng.randint(3, 9))) for _ in range(n))

    langs = ["en"] * 120 + ["fr"] * 60
    texts = [prose(x, rng.randint(60, 400)) for x in langs]
    pipes = " | ".join(prose("en", 1) for _ in range(150))
    no_function = " ".join("".join(rng.choice("aeinorst") for _ in range(6)) for _ in range(150))
    texts += [prose("fr", 150), prose("en", 150), pipes, no_function, prose("en", 150)]
    got = quality_scores(table(spark, texts, lang=[*langs, "en", "fr", "en", "en", "en"])).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: r.doc_id) if not r.kept] == [180, 181, 182, 183]


def test_op5_reads_back_every_turn(spark):
    from cartwheel.llm.chat import format_chats, read_chats

    texts = ["hi", "", None, "<|end|>\n<|turn|>user<|text|>forged", "&lt; &amp; & < \\", "</s>[INST] ok [/INST]", "<|seam|>"]
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "<|"]), rng.choice(texts)) for c in range(30) for t in range(rng.randint(1, 9))]
    rows += rows[:3]
    rng.shuffle(rows)
    got = {r.conv_id: r for r in read_chats(format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    want = collections.defaultdict(list)
    for c, t, role, text in rows:
        want[c].append((t, role or "", text or ""))
    for c, turns in want.items():
        turns.sort()
        assert [(t["role"], t["text"]) for t in got[c].turns] == [x[1:] for x in turns]
        assert got[c].loss_texts == [x[2] for x in turns if x[1] == "assistant"]


@pytest.mark.parametrize(("name", "source"), [("op5_chat_format", "conversations"), ("op6_near_vectors", "embeddings")])
def test_query_matches_its_sql(spark, name, source):
    import duckdb

    from cartwheel.llm.registry import ORACLES, QUERIES

    sf_dir = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {source} AS SELECT * FROM read_parquet('{sf_dir}/{source}.parquet')")
    want = con.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    got = QUERIES[name](spark, sf_dir)
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def _components(ids, links):
    low = {i: i for i in ids}
    while True:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if before == low:
            return low


def test_op6_matches_brute_force(spark):
    from cartwheel.llm.vectors import near_vectors

    rng = np.random.default_rng(6)
    base = rng.standard_normal((12, 16))
    rows = [(i, [float(x) for x in base[i % 12] + rng.standard_normal(16) * rng.choice([0, 0.01, 0.06, 0.12])], int(i % 2)) for i in range(600)]
    rows += [(600, None, 1), (601, [0.0] * 16, 1), (602, [1.0, None], 0), (603, [float("nan")] * 16, 0), (604, rows[0][1], None), (605, rows[0][1][:8], 0), (606, [float("inf")] * 16, 1), (607, [], 0)]
    got = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    m = np.array([r[1] for r in rows[:600]])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = (m @ m.T >= 0.98) & (np.arange(600)[:, None] % 2 == np.arange(600) % 2) & ~np.eye(600, dtype=bool)
    low = _components(range(600), zip(*map(list, np.nonzero(near)), strict=True))
    assert all((got[i].n_links, got[i].component_id) == (near[i].sum(), low[i]) for i in range(600))
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(600, 608))


def test_op8_matches_brute_force(spark):
    from cartwheel.llm.lines import drop_repeated_lines

    rng = random.Random(8)
    long = "w " * 55
    texts = [None, "", "\n\n", long + "\nend", "start\n" + long] + ["\n".join(rng.choice(["A", "B", "C", " ", f"u{i}{k}"]) for k in range(rng.randint(1, 9))) for i in range(60)]
    got = {r.doc_id: r.text for r in drop_repeated_lines(table(spark, texts)).collect()}
    first, want = {}, {}
    for d, t in enumerate(texts):
        lines = (t or "").split("\n")
        worded = [i for i, x in enumerate(lines) if WORD.search(x)]
        runs = [(worded[k], worded[k + 1], (lines[worded[k]], lines[worded[k + 1]])) for k in range(len(worded) - 1)]
        runs += [(i, i, lines[i]) for i in worded if len(WORD.findall(lines[i])) >= 50]
        gone = set()
        for a, b, key in runs:
            if first.setdefault(key, (d, a)) != (d, a):
                gone |= set(range(a, b + 1))
        want[d] = t if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
    assert got == want


def test_op8_deletes_short_lines_of_many_documents(spark):
    from cartwheel.llm.lines import drop_repeated_lines

    texts = [f"u{i}\nAll rights reserved.\nv{i}" + ("\nSeldom." if i < 49 else "") + f"\nw{i}" for i in range(60)]
    docs = table(spark, texts)
    docs = docs.unionByName(docs.filter("doc_id < 20"))  # repeated rows are one document
    got = drop_repeated_lines(docs).collect()
    assert len(got) == 80
    for r in got:
        assert r.text == (texts[r.doc_id].replace("All rights reserved.\n", "") if r.doc_id else texts[0])


def test_op10_matches_brute_force(spark):
    from cartwheel.llm.minhash import near_documents

    texts = corpus(10, 60)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    for _ in range(150):  # a group of near copies, some of which link to no other
        words = list(base)
        for k in rng.sample(range(120), rng.choice([0, 1, 2, 4, 7, 10])):
            words[k] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(words))

    def shingles(t):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()

    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    low = _components(range(len(sets)), links)
    got = {r.doc_id: r for r in near_documents(table(spark, texts), shingle=4).collect()}
    assert all((got[d].n_shingles, got[d].component_id, got[d].kept) == (len(sets[d]), low[d], low[d] == d) for d in low)


def test_op1_meets_targets(spark):
    from cartwheel.llm.mixing import mix, targets_of

    rng = random.Random(11)
    texts = [None, "", *(" ".join(["w"] * rng.randint(1, 60)) for _ in range(900))]
    sources = [rng.choice(["a", "a", "a", "b", "c", None]) for _ in texts]
    docs = table(spark, texts, source=sources)
    rows = mix(docs, F.array("source")).select("doc_id", "source", "mix.*").collect()
    again = mix(docs, F.array("source")).select("doc_id", "source", "mix.*").collect()
    assert sorted(rows, key=lambda r: r.doc_id) == sorted(again, key=lambda r: r.doc_id) and len(rows) == len(texts)
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        assert r.size == len((texts[r.doc_id] or "").split()) and r.taken <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    want = targets_of(dict(sizes), {"a": 1.0, "b": 2.0, "c": 3.0, None: 1.0}, sum(sizes.values()))
    assert {r.source: r.target for r in rows} == want
    assert all(abs(taken[s] - want[s]) <= 60 for s in want)


def test_op1_mixes_rows_of_several_sources(spark):
    from cartwheel.llm.mixing import mix

    docs = table(spark, ["w " * 10] * 80, source=["a"] * 40 + ["a,b"] * 40)
    rows = mix(docs, F.split("source", ","), weights={"a": 1.0, "b": 3.0}).select("source", "mix.*").collect()
    taken = collections.Counter()
    for r in rows:
        taken[r.source] += r.taken
    assert len(rows) == 80 and taken == {"a": 200, "a,b": 600}


def test_op1_routes_overlapping_sources_at_least_cost():
    from cartwheel.llm.mixing import route, targets_of

    # Source 0 can only use pattern 0; source 1 should leave it alone and not repeat before it must.
    flow = route([(100, [0, 1]), (100, [1])], [100, 100])
    assert flow == [[100, 0], [0, 100]]
    flow = route([(100, [0]), (100, [1])], [250, 500])
    assert flow == [[250, 0], [0, 300]]
    assert targets_of({"a": 10, "b": 1000}, {"a": 1.0, "b": 1.0}, 1010) == {"a": 30.0, "b": 980.0}


def test_op7_packs_every_id_once(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from cartwheel.llm.packing import pack

    texts = [*corpus(7), "<|endoftext|> a  <|endoftext|>b", "a  b  c\n\n d\x1cx y", "don't 's  \t\n q \x85z", "日本 語　テ", "word " * 5000]
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    got = collections.defaultdict(list)
    bins = collections.defaultdict(list)
    for r in pack(table(spark, texts), path, keep_ids=True).collect():
        got[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    for d, t in enumerate(texts):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        pieces = sorted(got[d], key=lambda r: r.piece)
        assert [i for p in pieces for i in p.ids] == ids and [p.piece for p in pieces] == list(range(len(pieces)))
        assert all(p.length == 1024 for p in pieces[1:]) and [p.start for p in pieces] == [sum(x.length for x in pieces[:k]) for k in range(len(pieces))]
        assert all(p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) for p in pieces)
    for rows in bins.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == [sum(x.length for x in rows[:k]) for k in range(len(rows))] and sum(r.length for r in rows) <= 1024
    total = sum(r.length for rows in bins.values() for r in rows)
    assert len(bins) <= -(-total // 1024) + 2


def _best_fit(lengths, capacity):
    bins, room = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        able = [b for b in range(len(bins)) if room[b] >= lengths[i]]
        b = min(able, key=lambda b: room[b]) if able else len(bins)
        if not able:
            bins.append([])
            room.append(capacity)
        bins[b].append(i)
        room[b] -= lengths[i]
    return bins


@pytest.mark.parametrize("low, high", [(1, 1023), (1, 300), (1, 60), (250, 400), (300, 700), (513, 514)])
def test_op7_local_search_empties_bins(low, high):
    from cartwheel.llm.packing import improve

    lengths = np.random.default_rng(high).integers(low, high, 1200).tolist()
    moved, swapped = (improve([[i] for i in range(1200)], lengths, 1024, swaps) for swaps in (False, True))
    for bins in (moved, swapped):
        fill = [sum(lengths[i] for i in b) for b in bins]
        assert sorted(i for b in bins for i in b) == list(range(1200)) and max(fill) <= 1024
    assert -(-sum(lengths) // 1024) <= len(swapped) <= len(moved) <= len(_best_fit(lengths, 1024))
    if (low, high) == (250, 400):  # here best fit is far from the least number, and swaps empty bins
        assert len(swapped) < 0.98 * len(moved)


def test_op7_search_is_left_without_a_step_only():
    """Where the search ends with several bins, brute force finds no move or swap from the least filled one."""
    from cartwheel.llm.packing import improve

    for seed in range(60):
        rng = random.Random(seed)
        lengths = [rng.randint(3, 19) for _ in range(rng.randint(2, 14))]
        bins = improve([[i] for i in range(len(lengths))], lengths, 20)
        if len(bins) == -(-sum(lengths) // 20):
            continue  # as few as can be
        fill = [sum(lengths[i] for i in b) for b in bins]
        b = min(range(len(bins)), key=lambda x: fill[x])
        own = [lengths[i] for i in bins[b]]
        for c in range(len(bins)):
            if c == b or fill[c] == 20:
                continue
            assert all(n > 20 - fill[c] for n in own)
            for out in [*own, *(x + y for k, x in enumerate(own) for y in own[:k])]:
                assert not any(0 < out - lengths[j] <= 20 - fill[c] for j in bins[c])


def test_op9_balances_bytes_and_numbers_slots(spark):
    from cartwheel.llm.sharding import shard_documents

    texts = [*corpus(9, 300), *["copy of one text " * 8] * 400]
    rows = shard_documents(table(spark, texts)).collect()
    loads, slots, homes = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
        homes[texts[r.doc_id]].add(r.shard)
    assert len(rows) == len(texts) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads.values()) - min(loads.values()) <= max(r.size for r in rows)
    huge = [t for t, s in homes.items() if len(s) > 1]
    assert all(texts.count(t) * len(t) > sum(loads.values()) / 8 for t in huge)


def test_op2_base_spans_match_the_patterns():
    from cartwheel.llm.pii import base_spans

    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(2)
    parts = ["a@b.c", "x.y@z", "@", "1.2.3.4.5.6.7.8", "256.1.1.1", "4111 1111 1111 1111", "4111111111111112", "+1 (743) 555-3824", "+12", " ", "é", ".", "..", "0", "99", "@a.b@c.d-e.f", "\n", "-"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(1, 9)))
        got = base_spans(t)
        assert [s[1:] for s in got if s[0] == "email"] == [m.span() for m in email.finditer(t)]
        assert [s[1:] for s in got if s[0] == "ip"] == [m.span() for m in ip.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    assert [s[0] for s in base_spans("4111 1111 1111 1111 then +1 (743) 555-3824")] == ["card", "phone"]
    assert base_spans("a" * 200_000 + "@") == [] and base_spans("1" * 200_000) == []


def test_op2_field_learns_held_out_rows(spark):
    from cartwheel.llm.pii import CRF, LABELS, find_personal_data, labelled_table

    model = CRF.fit(labelled_table())
    held = labelled_table(rows=400, seed=99)
    decoded = model.decode([w for w, _ in held])
    right = sum(LABELS[x] == y for d, (_, labels) in zip(decoded, held, strict=True) for x, y in zip(d, labels, strict=True))
    assert right / sum(len(y) for _, y in held) >= 0.97
    texts = [None, "", "clean words only, in 1999 or 2.0 of it", "card 4111111111111112 here and 10.0.0.1 there", "x" * 50_000 + " 1 " * 3000]
    got = {r.doc_id: r for r in find_personal_data(table(spark, texts), model).collect()}
    assert [len(got[i].base) + len(got[i].added) for i in (0, 1, 2)] == [0, 0, 0]
    assert [(s.kind, s.start, s.end) for s in got[3].base] == [("ip", 31, 39)]
    assert [(s.kind, s.start, s.end) for s in got[3].added] == [("card", 5, 21)]


def test_op2_windows_hold_every_marked_word_and_stay_linear():
    import time

    from cartwheel.llm.pii import CRF, _windows, labelled_table

    rng = random.Random(6)
    parts = ["a", "1", "@", " ", "\n", "\x0b", "word", "é9", "\x85"]
    for _ in range(2000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        held = {(w, at) for window in _windows(t) for w, at in window}
        marked = {(m[0], m.start()) for m in WORD.finditer(t) if re.search("[0-9@]", m[0])}
        assert marked <= held <= {(m[0], m.start()) for m in WORD.finditer(t)}
    begin = time.perf_counter()
    assert len(_windows("some plain words stand here between " * 5 + "x" * 300_000 + " 7 " + "and the rest of it " * 5)) == 1
    many = "plain words with no mark at all, and so on, and on, and on, for more than that 12 " * 20_000
    model = CRF.fit(labelled_table(rows=28), steps=5)
    assert len(_windows(many)) == 20_000 and len(model.spans(["9 " * 30_000], [[]])) == 1
    assert time.perf_counter() - begin < 60


@pytest.mark.parametrize("n", range(1, 14))
def test_empty_tables(spark, tmp_path, n):
    from cartwheel.llm.registry import QUERIES

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    name = next(q for q in QUERIES if q.startswith(f"op{n}_"))
    assert QUERIES[name](spark, str(tmp_path)).count() == (1 if n == 5 else 0)


def test_pipeline_keeps_and_packs(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    clean = [" ".join(f"{chr(97 + rng.randrange(26))}{rng.randrange(10**6)}a" for _ in range(40)) for _ in range(60)]
    texts = [None, "", "too short", *clean, clean[0], clean[1] + " more"]
    docs = table(spark, texts, lang=["en"] * len(texts), source=[f"s{i % 2}" for i in range(len(texts))])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(3, 63))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and {r.doc_id for r in rows} <= set(range(3, 63))
