"""Brute force beside the operators that shuffle, on awkward rows and skewed groups."""

import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from tickweave.llm import ann, line_dedup, packing, pieces, simhash

from .tables import AWKWARD, docs

LOWER = {i: i + 32 for i in range(65, 91)}


def _fingerprint(t, width=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    shingles = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_simhash_matches_brute_force(spark):
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(120)) for _ in range(6)]
    texts = [*AWKWARD]
    for b in base:
        for k in range(8):
            w = b.split()
            for _ in range(k // 2):
                w[rng.randrange(len(w))] = f"v{rng.randrange(99)}"
            texts.append(" ".join(w))
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    assert len(got) == len(texts)
    fps = {i: _fingerprint(t) for i, t in enumerate(texts)}
    roots = _components(list(fps), lambda a, b: bin(fps[a] ^ fps[b]).count("1") <= 3)
    for i in fps:
        assert got[i]["fp"] % (1 << 64) == fps[i], i
        assert got[i]["component_id"] == roots[i], i


def test_links_of_hot_keys(spark):
    rng = np.random.default_rng(3)
    near = [int(np.bitwise_xor.reduce([np.uint64(1) << np.uint64(b) for b in rng.choice(20, 3, replace=False)])) for _ in range(300)]
    values = sorted({v - (1 << 64) if v >> 63 else v for v in [*near, *(int(x) for x in rng.integers(0, 1 << 63, 200))]})
    edges = simhash.links(spark.createDataFrame([(v, v, 0) for v in values], "id long, fp long, x long"), simhash.block_masks(3, 6), 3, few=4, chunk=32)
    assert edges.count() < 40 * len(values)
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    want = _components(values, lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= 3)
    assert {v: got.get(v, v) for v in values} == want


def test_long_chains_settle(spark):
    n = 300
    edges = spark.createDataFrame([((i * 7919) % n, ((i + 1) * 7919) % n) for i in range(n - 1)], "a long, b long")
    assert {r["root"] for r in simhash.components(edges).collect()} == {0}
    assert simhash.components(edges.limit(0)).count() == 0


def test_near_dedup_keeps_one_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = docs(spark, [text, text, text.replace("w7 ", "x "), "else where is one more text", None], ids=[4, 2, 2, 9, None])
    kept = simhash.drop_near_duplicates(spark, rows, "")
    assert kept.columns == rows.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 2), (False, 9), (True, 0)]
    assert simhash.drop_near_duplicates(spark, rows.limit(0), "").count() == 0


def test_near_dedup_finds_edited_copies(spark):
    rng = random.Random(6)
    texts, copies = [], set()
    for g in range(40):
        w = [f"w{rng.randrange(5000)}" for _ in range(300)]
        texts.append(" ".join(w))
        for _ in range(3):
            v = list(w)
            for _ in range(3):  # a Jaccard similarity of about 0.9
                v[rng.randrange(len(v))] = f"v{rng.randrange(5000)}"
            copies.add(len(texts))
            texts.append(" ".join(v))
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(spark, docs(spark, texts), "").collect()}
    assert set(range(len(texts))) - copies <= kept
    assert len(copies & kept) <= 0.05 * len(copies)


def test_near_dedup_finds_isolated_pairs(spark):
    rng = random.Random(8)
    texts, want, alike = [], set(), 0
    for g in range(120):
        w = [f"w{rng.randrange(9**9)}" for _ in range(304)]
        v = list(w)
        for at in rng.sample(range(5, 299, 10), 6 if g % 2 else 10):  # no shingle holds two: Jaccard 270 / 330 or 250 / 350
            v[at] = f"v{rng.randrange(9**9)}"
        a, b = ({tuple(x[i : i + 5]) for i in range(300)} for x in (w, v))
        if len(a & b) >= 0.8 * len(a | b):
            alike += 1
            want.add(2 * g + 1)
        texts += [" ".join(w), " ".join(v)]
    gone = set(range(len(texts))) - {r["doc_id"] for r in simhash.drop_near_duplicates(spark, docs(spark, texts), "").collect()}
    assert alike == 60 and gone <= want and len(gone) >= 0.98 * alike


def test_near_dedup_keeps_other_texts_of_a_repeated_id(spark):
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    rows = docs(spark, [texts[0], texts[1], texts[1], texts[1], texts[2]], ids=[1, 1, 1, 5, 6])
    assert sorted((r["doc_id"], r["text"][0]) for r in simhash.drop_near_duplicates(spark, rows, "").collect()) == [(1, "a"), (1, "b"), (6, "c")]


def _met(spark, nodes, linked, **options):
    """Components of (doc, n, keys, sig) nodes of which the linked pairs are similar, and the pairs that were verified."""
    asked = []

    def verified(pairs):
        rows = [(r["a"], r["b"]) for r in pairs.collect()]
        asked.extend((a["doc"], b["doc"]) for a, b in rows)
        kept = [(a, b) for a, b in rows if linked(a["doc"], b["doc"])]
        return spark.createDataFrame(kept, pairs.schema) if kept else pairs.limit(0)

    df = spark.createDataFrame([((d, 0), n, keys, sig) for d, n, keys, sig in nodes], "id struct<doc:long,row:long>, n int, keys array<long>, sig binary")
    roots = {r["node"]["doc"]: r["root"]["doc"] for r in simhash.similar_components(df, 0.8, verified, **options).collect()}
    return {d: roots.get(d, d) for d, *_ in nodes}, asked


def test_hot_keys_of_two_groups_and_what_stays_apart(spark):
    rng = random.Random(9)
    # three groups that share every key, one of them met only through others, and nodes like none
    base = [bytes(rng.randrange(256) for _ in range(144)) for _ in range(3)]
    group = {d: d % 4 for d in range(120)}
    nodes = [(d, 100, [1, 2], base[g] if g < 3 else bytes(rng.randrange(256) for _ in range(144))) for d, g in group.items()]
    linked = lambda a, b: group[a] == group[b] < 3
    got, asked = _met(spark, nodes, linked, few=4, chunk=16)
    assert got == {d: min(x for x in group if group[x] == g) if g < 3 else d for d, g in group.items()}
    assert len(set(asked)) < 119 + 120 * 8  # a pair for each node with the first one, and forests of what is left


def test_copies_of_a_template_take_a_pair_each(spark):
    for n in (100, 400):
        nodes = [(d, 196, [k * 10 + d % 3 for k in range(24)] + [999], bytes(144)) for d in range(n)]
        got, asked = _met(spark, nodes, lambda a, b: True)
        assert set(got.values()) == {0} and len(asked) <= 4 * n


def test_no_link_is_lost_beside_the_leader(spark):
    # a chain: each node is similar to its neighbours alone, and all share one key
    nodes = [(d, 100, [5], bytes(d if i < 20 else 0 for i in range(144))) for d in range(40)]
    got, asked = _met(spark, nodes, lambda a, b: abs(a - b) == 1, few=4, chunk=16)
    assert set(got.values()) == {0} and set(asked) >= {(d, d + 1) for d in range(39)}


def test_near_dedup_of_one_template_is_that_of_all_pairs(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(9**9)}" for _ in range(120)]
    texts = []
    for k in range(60):
        w = list(base)
        for at in rng.sample(range(120), k % 5):
            w[at] = f"v{rng.randrange(9**9)}"
        texts.append(" ".join([*w, *(["tail"] * 9 if k % 7 == 0 else [])]))
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    want = _components(range(60), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(spark, docs(spark, texts), "").collect()}
    assert kept == set(want.values()) and len(kept) > 1 or kept == {0} == set(want.values())


def _alike(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    s = next((i for i, (x, y) in enumerate(zip(a[::-1], b[::-1])) if x != y), min(len(a), len(b)))
    return p + s >= max(len(a), len(b)) - 1


def _gone(texts, min_words=1):
    lines = [(d, n, re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip().split()) for d, t in texts for n, line in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if len(x[2]) >= min_words]
    out = {}
    for k, (d, n, w) in enumerate(lines):
        for d0, n0, v in lines[:k]:
            if v == w or len(v) >= 8 and len(w) >= 8 and _alike(v, w):
                out[d, n] = (d0, n0)
                break
    return out


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(11)
    base = [[f"w{rng.randrange(30)}" for _ in range(rng.randrange(4, 14))] for _ in range(25)]
    texts = []
    for d in range(60):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            w = list(rng.choice(base))
            kind = rng.randrange(4)
            at = rng.randrange(len(w))
            if kind == 1:
                w[at] = f"w{rng.randrange(30)}"
            elif kind == 2:
                del w[at]
            elif kind == 3:
                w.insert(at, f"w{rng.randrange(30)}")
            lines.append(rng.choice([" ", "  ", "\t"]).join(w).title() if d % 2 else " ".join(w))
        texts.append("\n".join(lines))
    texts = [*AWKWARD, *texts]
    rows = docs(spark, texts)
    want = _gone(list(enumerate(texts)))
    got = {(r["doc"], r["n"]): (r["of"]["doc"], r["of"]["n"]) for r in line_dedup.duplicate_lines(rows).collect()}
    assert got == want
    longer = line_dedup.duplicate_lines(rows, min_words=5)
    assert {(r["doc"], r["n"]): (r["of"]["doc"], r["of"]["n"]) for r in longer.collect()} == _gone(list(enumerate(texts)), 5)
    out = {r["doc_id"]: r for r in line_dedup.drop_duplicate_lines(spark, rows, "").collect()}
    for d, t in enumerate(texts):
        kept = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in want)
        assert out[d]["text"] == kept, d
        assert out[d]["n_chars"] == (None if kept is None else len(kept))
    assert list(out[0].asDict()) == rows.columns


def test_hot_lines(spark):
    rows = docs(spark, [f"the same line of eight words is here {i % 40}" for i in range(400)])
    assert line_dedup.duplicate_lines(rows).count() == 399
    assert line_dedup.duplicate_lines(rows.limit(0)).count() == 0
    same = docs(spark, ["a line that all share\nand one of its own %d" % (i % 7) for i in range(3000)])
    assert line_dedup.duplicate_lines(same).count() == 2999 + 2993


def test_packing_places_every_id_once(spark):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    texts = [*AWKWARD, *(" ".join(f"word{rng.randrange(50)}" for _ in range(rng.randrange(0, 900))) for _ in range(80)), *["same length here"] * 60]
    rows = docs(spark, texts)
    tok = Tokenizer.from_file(packing.tokenizer_path())
    want = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    placed = packing.pack(rows, packing.tokenizer_path(), capacity=1024, rows_per_bucket=20).collect()
    by_doc, by_sequence = {}, {}
    for r in placed:
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        ids = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes()) and r["doc_tokens"] == len(want[r["doc_id"]])
    for i, ids in want.items():
        at = 0
        for start, length in sorted(by_doc[i]):
            assert start == at
            at += length
        assert at == len(ids)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding < 0.03 * sum(map(len, want.values()))


def test_fullest_is_best():
    rng = random.Random(8)
    for _ in range(60):
        counts = {rng.randrange(1, 40): rng.randrange(1, 4) for _ in range(rng.randrange(1, 7))}
        sums = {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1) if s + k * n <= 64}
        found = packing.fullest(counts, 64)
        assert sum(n * c for n, c in found.items()) == max(sums)
        assert all(c <= counts[n] for n, c in found.items())


def test_encoder_matches_the_tokenizer_on_every_character():
    from tokenizers import Tokenizer

    e, tok = packing.Encoder(packing.tokenizer_path()), Tokenizer.from_file(packing.tokenizer_path())
    assert e.by_word
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 16384):
        texts = [f"ab{c}cd {c}{c}1" for c in points[i : i + 16384] if not e.unknown.search(c)]
        # all others go to the tokenizer whole
        for t, ids, want in zip(texts, e.encode(texts), tok.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == want.ids, repr(t)
    for t in ("ab\u0558cd", "a <|startoftext|> b<|endoftext|>", "x\U00010940y"):
        assert np.frombuffer(e.encode([t])[0], "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_other_tokenizers_are_followed(tmp_path):
    import json

    with open(packing.tokenizer_path(), encoding="utf-8") as f:
        made = json.load(f)
    made["normalizer"]["normalizers"] = made["normalizer"]["normalizers"][:2]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(made))
    e = packing.Encoder(str(path))
    assert not e.by_word
    t = "Upper CASE and lower"
    assert np.frombuffer(e.encode([t])[0], "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_encoder_matches_the_tokenizer():
    e = packing.encoder(packing.tokenizer_path())
    rng = random.Random(1)
    alphabet = ["a", "é", "É", "İ", "Σ", "'s", "'re", "'", "1", "½", "日", "_", "!!", " ", "\t", "\n", "\x1c", "\x85", "\xa0", " ", "​", "́", "ﬁ", "🙂", "<|endoftext|>", "the", "Word", "ß", "x" * 60]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(800)]
    for t, ids in zip(texts, e.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces_match_the_library_in_any_chunks(spark):
    m = pieces.model(pieces.model_path())
    rng = random.Random(4)
    odd = ["".join(rng.choice("aeiou tnsrhl▁\n\t  zé日x0.,🙂") for _ in range(rng.randrange(300))) for _ in range(60)]
    runs = ["".join(rng.choice(["the", "ing", "tion", "http", "www", " " * rng.randrange(1, 40)]) for _ in range(60)) for _ in range(20)]
    solid = ["".join(rng.choice(["the", "ing", "tion", "er", "qz"]) for _ in range(150)) for _ in range(10)]
    texts = [*AWKWARD, *odd, *runs, *solid, solid[0]]
    made = pieces.encode(docs(spark, texts), pieces.model_path(), chunk=97)
    got = {}
    for r in sorted(made.collect(), key=lambda r: (r["doc_id"], r["chunk"])):
        assert r["round_trip"]
        got.setdefault(r["doc_id"], []).extend(r["ids"])
    for i, t in enumerate(texts):
        assert got[i] == m.sp.encode(t or ""), i
    back = {}
    for r in sorted(pieces.decode(made, pieces.model_path()).collect(), key=lambda r: (r["doc_id"], r["chunk"])):
        back[r["doc_id"]] = back.get(r["doc_id"], "") + r["text"]
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(texts))


def test_a_giant_document_of_several_chunks(spark):
    rng = random.Random(6)
    text = " ".join("".join(rng.choice("etaoinshrdlucé日") for _ in range(rng.randrange(1, 12))) for _ in range(22_000))
    solid = "".join(rng.choice(["the", "ing", "tion", "er", "qz"]) for _ in range(30_000))  # no place where paths part
    rows = spark.createDataFrame([(1, text), (2, solid), (3, text), (3, text)], "doc_id long, text string")
    got = {}
    for r in sorted(pieces.encode(rows, pieces.model_path()).collect(), key=lambda r: (r["doc_id"], r["chunk"])):
        assert r["round_trip"]
        got.setdefault(r["doc_id"], []).append(r)
    m = pieces.model(pieces.model_path())
    assert len(got[1]) == len(text) // 32768 + 1 > 3 and len(got[3]) == 2 * len(got[1])
    for i, t in ((1, text), (2, solid)):
        assert [x for r in got[i] for x in r["ids"]] == m.sp.encode(t)
    with pytest.raises(ValueError):
        pieces.encode(rows, pieces.model_path(), chunk=m.longest)


def test_max_plus_product_is_associative():
    rng = np.random.default_rng(0)
    a, b, c = (np.where(rng.random((5, 5)) < 0.5, 0, -np.inf).astype(np.float32) for _ in range(3))
    assert np.array_equal(pieces.combine(pieces.combine(a, b), c), pieces.combine(a, pieces.combine(b, c)))


def _exact(rows, k=5):
    good = {i: np.array(v, float) for i, v in rows if v is not None and i is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}
    out = {}
    for q in (i for i in good if i % 50 == 0):
        scores = sorted((-float(good[q] @ v / np.linalg.norm(good[q]) / np.linalg.norm(v)), i) for i, v in good.items() if i != q)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def test_neighbours_reach_recall(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + 0.7 * rng.normal(size=24)).tolist()) for i in range(3000)]
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, few=8, block=5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    paired = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, few=10**6)
    assert {(r["query_id"], r["vec_id"], r["score"]) for r in paired.collect()} == {(q, *x) for q in got for x in got[q]}
    want = _exact(rows)
    assert set(got) == set(want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9


def test_large_tables_have_smaller_shares_of_candidates(spark):
    rng = np.random.default_rng(3)
    share = []
    for n in (1000, 8000):
        v = [(i, x.tolist()) for i, x in enumerate(rng.normal(size=(n, 16)))]
        classes = spark.createDataFrame(v, "rep long, v array<double>")
        asking = classes.where("rep % 50 = 0").selectExpr("rep AS query", "v AS q")
        pairs, large, _ = ann.candidates(classes, asking, n, 16, few=10**6)
        assert large.count() == 0
        share.append(pairs.count() / (n // 50) / n)
    assert share[1] < 0.6 * share[0]


def test_probes_are_the_likeliest_keys():
    x = ann._unit(np.random.default_rng(2).normal(size=(5, 8)))
    h = ann.Hashes(8, 6, 3, 1)
    every = h.probes(x, 3 * 64)
    assert all(sorted(row.tolist()) == list(range(3 * 64)) for row in every)
    assert all(set(h.probes(x, 20)[i].tolist()) == set(every[i, :20].tolist()) for i in range(5))
    own = h.keys(x)
    assert all(own[t, i] in every[i, :60] for t in range(3) for i in range(5))


def test_neighbours_of_large_numbers(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e-300, 2e-300]), (2, [3e307, 1e307]), (3, [-1.0, 0.0])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2, 3]
    assert [r["score"] for r in got] == pytest.approx([3 / 10**0.5, 2 / 5**0.5, -(0.5**0.5)])


def test_neighbours_of_awkward_vectors(spark):
    rows = [(i, [1.0, 0.0, 2.0]) for i in range(200)] + [(200, None), (201, [0.0, 0.0, 0.0]), (202, [float("nan"), 1.0, 1.0]), (203, [float("inf"), 1.0, 1.0]), (204, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (205, [1.0, 0.1, 2.0]), (250, [3.0, -1.0, 0.0]), (250, [3.0, -1.0, 0.0]), (300, [])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, b string, t int")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = _exact(rows)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]])
    assert ann.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = df.where("vec_id IN (0, 205, 250)")
    assert ann.nearest(few, F.col("vec_id") % 50 == 0).count() == 4


def test_vectors_of_other_lengths_take_no_part(spark):
    r = np.random.default_rng(4)
    vector = lambda n: r.normal(size=n).tolist()
    rows = [(i, vector(8)) for i in range(60)] + [(100 + i, vector(3 + i % 2)) for i in range(20)] + [(200, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    of = lambda d: sorted(map(tuple, ann.nearest(d, F.col("vec_id") % 50 == 0).collect()))
    assert of(df) == of(df.where("vec_id < 60")) and len(of(df)) == 10
    tie = spark.createDataFrame([(0, [1.0, 0.0]), (50, [1.0, 0.0, 0.0])], "vec_id long, embedding array<double>")
    assert of(tie) == []
