"""Token alignment, the language model and the conversation trie against plain versions of themselves."""

import hashlib
import math
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.llm import alignment, conversation_trie, count_shards, language_model
from tickweave.llm.queries import ORACLES

from .tables import AWKWARD, docs

A, B = (alignment.token_path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SF = "/root/testdata/sf0.001"


# token alignment


def _plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    names = alignment._byte_names()
    held, counts = [], Counter()
    for t in texts:
        held.append(None)
        if not t:
            continue
        ids = [a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)]
        raw = [[bytes(names[c] for c in a.id_to_token(i)) for i in ids[0]], [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]]
        if any(b"".join(r) != (" " + t).encode() for r in raw):
            continue
        ends = [np.cumsum([len(x) for x in r]).tolist() for r in raw]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in cuts]
        for side in (0, 1):
            for i, e in zip(ids[side], ends[side], strict=True):
                groups[bisect_left(cuts, e)][side].append(i)
        links = [(x, y) for p, q in groups for x in p for y in q]
        counts.update(set(links))
        held[-1] = ids, groups, links
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(n, best.get(x, 0))
    out = []
    for h in held:
        if h is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        ids, groups, links = h
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((len(ids[0]), len(ids[1]), len(groups), len(links), sum(counts[k] == best[k[0]] for k in links), sum(counts[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


HARD = [
    "don't we'll  two  spaces\n\n lines \n end ", " starts with a space", "trailing\n", "tab\tand nbsp\xa0and em", "<|endoftext|> </s> <unk> <0x41>", "under▁score", "日本語のテキスト。中文 العربية עברית ไทย",
    "\U0001f642\U0001f468‍\U0001f469‍\U0001f467 \U000104a0 ՘", "a\x00b\x1fc", "naïve café é", "1234567 3.14159 x=y+z;", "word　wide", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa " * 30, "z" * 5000, "\n", " ", "ﬁ ½ Å",
]


def test_alignment_is_that_of_the_libraries(spark):
    texts = [*AWKWARD, *HARD, *HARD[:3]]
    rows = docs(spark, texts, ids=[1, *range(1, len(texts))])  # an id twice
    got = alignment.align(rows.repartition(3), A, B, with_groups=True).collect()
    want = sorted(zip([1, *range(1, len(texts))], _plain_alignment(texts), strict=True))
    assert sorted((r["doc_id"], (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"])) for r in got) == want
    assert all(r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") for r in got)
    assert {r["n_groups"] for r in got if r["groups"]} == {r["groups"].count(";") + 1 for r in got if r["groups"]}


def test_alignment_with_few_units_kept_and_large_groups_counted(spark, monkeypatch):
    texts = [t for t in HARD if len(t) < 2000]
    t = alignment.Tokens(A, B)
    plain = _plain_alignment(texts)
    for name, value in (("SPELLED_OUT", 1), ("LONGEST", 3), ("TOGETHER", 2)):
        monkeypatch.setattr(alignment, name, value)
        t.clear()
        units, ends = t.read(texts)
        got = [tuple(x) for x in np.stack([alignment._sums(t.numbers[units, i], ends) for i in range(4)], axis=1).tolist()]
        assert got == [w[:4] for w in plain]
        stops, _, times = alignment._document_links(t, units, ends)
        assert [int(times[a:b].sum()) for a, b in zip([0, *stops[:-1]], stops, strict=True)] == [w[3] for w in plain]


def test_alignment_of_no_rows(spark):
    assert alignment.align(docs(spark, ["x"]).where("false"), A, B).count() == 0


def test_the_faster_library_agrees_on_known_characters():
    t = alignment.ByteTokens(A)
    assert t.parts
    known = [c for c in map(chr, range(0x20, 0x3100)) if alignment.PLAIN.fullmatch(c) and not alignment.ODD_SPACE.fullmatch(c)]
    for i in range(0, len(known), 200):
        text = "".join(f" a{c}1{c}{c}. {c}'s" for c in known[i : i + 200])
        assert t.fast.encode_ordinary(text) == t.text(text)


def test_shards_of_counts(spark, monkeypatch):
    monkeypatch.setattr(count_shards, "MOST_KEYS", 10)
    keys = [7] * 5000 + list(range(-50, 400)) * 2 + [2**62, -(2**63)]
    df = spark.createDataFrame([(k, 1) for k in keys], "key long, n long").repartition(5)
    shards, tops, distinct, total = count_shards.write_shards(df, top_shift=4)
    want = Counter(keys)
    asked = np.unique(np.array([*want, 1000, -51, 2**61]))
    assert dict(zip(asked.tolist(), shards.counts(asked).tolist(), strict=True)) == {k: want.get(k, 0) for k in asked.tolist()}
    assert (distinct, total) == (len(want), len(keys)) and tops[0] == 5002 and tops[2**58] == 1
    parts = count_shards.PartialCounts(10)
    met = Counter()
    for i in range(0, len(keys), 97):
        for k, n in parts.add(np.array(keys[i : i + 97])):
            met.update(dict(zip(k.tolist(), n.tolist(), strict=True)))
    for k, n in parts.end():
        met.update(dict(zip(k.tolist(), n.tolist(), strict=True)))
    assert met == want


# language model


def _fold(i):
    return zlib.crc32(str(i).encode()) % 5


def _prose(n):
    r = np.random.default_rng(5)
    words = ["".join(r.choice(list("abcdeinorst"), r.integers(2, 8))) for _ in range(300)]
    return [" ".join(r.choice(words, r.integers(5, 300))).capitalize() + ".\n" for _ in range(n)]


@pytest.fixture(scope="module")
def scored(spark):
    texts = [*AWKWARD, *_prose(240)]
    rows = docs(spark, texts).repartition(3)
    model = language_model.fit(rows)
    return texts, model, {r["doc_id"]: r for r in language_model.score(rows, model).collect()}


def test_base_score_is_exact(scored):
    texts, model, got = scored
    tokens = lambda t: [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), b" "]
    counts = Counter(w for i, t in enumerate(texts) if _fold(i) != 1 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (_fold(i) == 1, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), rel_tol=1e-9)


def test_held_out_prose_is_predicted(scored):
    texts, _, got = scored
    held = [got[i] for i in range(len(AWKWARD), len(texts)) if _fold(i) == 1]
    size = sum(len(texts[r["doc_id"]].encode()) + 1 for r in held)
    assert -sum(r["score"] for r in held) / math.log10(2) / size < 2.5 < math.log2(11)
    assert all(r["score"] < 0 and math.isclose(r["bits_per_byte"], -r["score"] / math.log10(2) / (len((texts[r["doc_id"]] or "").encode()) + 1)) for r in got.values())


def test_probabilities_add_up_and_depend_on_the_text_alone(scored):
    texts, model, got = scored
    total = 0.0
    for symbol in range(64):  # in place of the end
        s = language_model.Slice([""], model.alphabet)
        s.symbols[s.start] = symbol
        total += 10.0 ** model.mixer.run(s, model.tables)[0]
    assert math.isclose(total, 1, rel_tol=1e-3)
    for i in (1, 3, 5, 40, 41):
        assert math.isclose(model.mixer.run(language_model.Slice([texts[i]], model.alphabet), model.tables)[0], got[i]["score"], rel_tol=1e-6)


def test_symbols_give_texts_back():
    alphabet = language_model.Alphabet(np.bincount(np.frombuffer(b"the quick brown fox \n" * 3, dtype=np.uint8), minlength=256))
    texts = ["The quick", "", None, "日本 \t\x00 Zé", "e" * 3000]
    s = language_model.Slice(texts, alphabet)
    byte = {int(x): b for b, x in enumerate(alphabet.symbol) if x != language_model.ESCAPE}
    for t, start, size in zip(texts, s.start.tolist(), s.size.tolist(), strict=True):
        got, out = s.symbols[start : start + size].tolist(), bytearray()
        assert got[-1] == language_model.LAST and s.symbols[start - language_model.PAD : start].tolist() == [language_model.LAST] * language_model.PAD
        i = 0
        while i < size - 1:
            out.append(got[i + 1] << 4 | got[i + 2] if got[i] == language_model.ESCAPE else byte[got[i]])
            i += 3 if got[i] == language_model.ESCAPE else 1
        assert bytes(out) == (t or "").encode().lower()


def test_counts_go_through_ranges(spark):
    layout = language_model.Layout(3)
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(0, 5, 5000) << 56 | r.integers(0, 1 << layout.hash_bits, 5000) << 8 | r.integers(0, 64, 5000))
    n = np.arange(1, len(keys) + 1)
    assert (language_model.unpacked(language_model.packed(keys)) == keys).all()
    parts = list(layout.ranges(keys, n))
    assert len({own for own, _, _ in parts}) == len(parts) > 1
    assert np.concatenate([np.cumsum(language_model.unpacked(k)) for _, k, _ in parts]).tolist() == keys.tolist()


def test_language_model_without_training_rows(spark):
    held = [i for i in range(60) if _fold(i) == 1][:4]
    out = language_model.score(docs(spark, ["a b", None, "a b", "x" * 3000], ids=held), language_model.fit(docs(spark, ["a"] * 4, ids=held))).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"]) for r in out] == [(0, 0, 0.0)] * 4 and out[0]["score"] == out[2]["score"] > out[3]["score"]
    none = docs(spark, ["a"]).where("false")
    assert language_model.score(none, language_model.fit(none)).count() == 0


def test_null_ids_teach_nothing(spark):
    rows = docs(spark, ["only here"]).withColumn("doc_id", F.lit(None).cast("long"))
    out = language_model.score(rows, language_model.fit(rows)).first()
    assert (out["doc_id"], out["held_out"], out["n_known"], out["train_tokens"]) == (None, False, 0, 0)


# conversation trie

TURNS = "conv_id long, turn long, role string, text string, node string, base long, words long"


def _plain_trie(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    nodes = defaultdict(list)
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        full = own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:]
        for d in range(len(full) + 1):
            nodes[tuple(full[:d])].append((c, d == len(full)))
    kids = Counter(k[:-1] for k in nodes if k)
    leaves, saved = Counter(), Counter()
    for k, m in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * words
            leaves[k[:d]] += kids[k] == 0
    first = {k: min(c for c, _ in m) for k, m in nodes.items()}
    ends = {k: hashlib.sha256(",".join(map(str, sorted(c for c, e in m if e))).encode()).hexdigest() for k, m in nodes.items()}
    return sorted((str((first[k], len(k), first[k[:-1]] if k else None, len(m), kids[k], leaves[k], saved[k], ends[k])) for k, m in nodes.items()))


NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _trie(spark, rows):
    df = spark.createDataFrame([(*r, "n", 1, 2) for r in rows], TURNS).repartition(3)
    return sorted(str(tuple(r[n] for n in NAMES)) for r in conversation_trie.trie(df).collect())


def _conversations():
    r = np.random.default_rng(2)
    rows = []
    for c in range(0, 90):
        if c in (20, 60):
            continue  # families without a base
        for t in range(int(r.integers(1, 6))):
            rows.append((c, t, ["user", "assistant"][t % 2], " ".join(["hello"] * int(r.integers(0, 3)))))
    rows += [(c, t, "user", f"turn {t} of a long one") for c in (100, 101) for t in range(300)]
    rows += [(1000 + i, t, "user", "the same\n \x0b words") for i in range(150) for t in range(2)]
    rows += [(200, None, "user", "null first"), (200, 0, None, None), (201, 3, "user", "x"), (201, 3, "user", "x"), (None, 1, "user", "lost"), (203, 5, "b", "y"), (203, 5, "a", "z"), (-5, 0, "user", "below"), (-25, 0, "user", "below"), (-20, 0, "u", "base")]
    return rows


def test_trie_is_that_of_a_plain_walk(spark):
    rows = _conversations()
    assert _trie(spark, rows) == _plain_trie(rows)


def test_trie_in_small_parts(spark, monkeypatch):
    for name, value in (("MOST_NODES", 3), ("OUT_ROWS", 10), ("CHUNK", 20)):
        monkeypatch.setattr(conversation_trie, name, value)
    rows = _conversations()
    df = spark.createDataFrame([(*r, "n", 1, 2) for r in rows], TURNS)
    made = [b for b in conversation_trie._families(iter(conversation_trie.family_turns(df).toArrow().to_batches()))]
    nodes = [r for b in made for r in b.to_pylist() if r["kind"] == conversation_trie._NODE]
    whole = Counter()
    for n in nodes:
        whole[n["node"]] += n["n"]
    assert sorted(whole.values()) == sorted(eval(x)[3] for x in _plain_trie(rows))  # noqa: S307
    assert len(nodes) > len(whole)


def test_trie_of_no_rows(spark):
    assert _trie(spark, []) == []


def test_trie_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    cur = con.execute(ORACLES["op13_conversation_trie"])
    at = [[d[0] for d in cur.description].index(n) for n in NAMES]
    want = sorted(str(tuple(r[i] for i in at)) for r in cur.fetchall())
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _trie(spark, rows) == want == _plain_trie(rows)


def test_contexts_of_all_training_texts_are_counted(spark):
    """The model's tables hold tuning texts too, those that teach the weights don't."""
    from tickweave.llm import language_model as lm

    docs = spark.createDataFrame([(i, f"text number {i} of some" + " more" * (i % 3)) for i in range(400)], "doc_id long, text string").repartition(2)
    training = lm._folds(docs).where(f"fold != {lm.HELD_OUT} AND fold >= 0").collect()
    assert any(r["tuning"] for r in training)
    made = []
    keep = lm.build_tables
    try:
        lm.build_tables = lambda whole, layout: made.append(whole) or keep(whole, layout)
        lm.fit(docs)
    finally:
        lm.build_tables = keep
    places = [sum(lm.unpacked(r["counts"]).sum() for r in whole.where(f"range >> {lm.Layout(2).range_bits} = {lm.WORD}").collect()) for whole in made]
    raw = [(len(r["text"].encode()) + 1, r["tuning"]) for r in training]
    alphabet = lm.Alphabet(lm._byte_counts(lm._folds(docs).where(f"fold != {lm.HELD_OUT} AND fold >= 0")))
    assert all(alphabet.symbol[b] != lm.ESCAPE for r in training for b in r["text"].encode())
    assert places == [sum(n for n, tuned in raw if not tuned), sum(n for n, _ in raw)]


def test_counts_leave_a_task_in_few_rows():
    """Words and keys go by ranges, not in a row each, and each word's count is whole."""
    import pyarrow as pa

    from tickweave.llm import language_model as lm

    texts = [f"w{i} w{i % 7}" for i in range(5000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([False] * 5000)], names=["text", "tuning"])
    layout = lm.Layout(1)
    given = list(lm._gathered(layout, lm.Alphabet(np.bincount(np.frombuffer("".join(texts).encode(), dtype=np.uint8), minlength=256)))(iter([batch])))
    assert sum(b.num_rows for b in given) < 100
    rows = sorted((r for b in given for r in b.to_pylist()), key=lambda r: r["range"])
    summed = [r for b in lm._summed(layout, iter([pa.RecordBatch.from_pylist(rows, schema=given[0].schema)])) for r in b.to_pylist() if r["word"] is not None]
    assert {r["word"]: r["n"] for r in summed} == Counter([w.encode() for t in texts for w in t.split()] + [lm.END] * 5000)


def test_windows_and_cells_by_brute_force():
    """The last six symbols before each place, and log-odds of cells whose check is the context's alone."""
    from tickweave.llm import language_model as lm

    rng = np.random.default_rng(4)
    alphabet = lm.Alphabet(np.arange(256, 0, -1))
    s = lm.Slice(["", "abc", None, "some words éé, and more"], alphabet)
    b = s.symbols.tolist()
    assert s.windows().tolist() == [sum(b[i - 1 - k] << 8 * k for k in range(6) if i > k) for i in range(len(b))]
    layout, at = lm.Layout(1), s.places()
    tables = lm.Tables([], [12] * lm.INPUTS, layout)
    tables._maps = [rng.integers(0, 1 << 63, 1 << 12, dtype=np.uint64) for _ in range(lm.INPUTS)]
    contexts, symbols = s.contexts(at, layout.hash_bits), s.symbols[at]
    for i, table in enumerate(tables._maps):  # every other place's first cell is its own
        cells = lm.cells_of(contexts[i], lm.SPREAD.take(symbols >> 3), i, 12, layout.hash_bits, layout.range_bits)[0][::2]
        table[cells] = table[cells] & np.uint64((1 << 56) - 1) | (contexts[i][::2] & 255).astype(np.uint64) << np.uint64(56)
    got = tables.inputs(contexts, symbols)
    for i, table in enumerate(tables._maps):
        both = np.stack(lm.cells_of(contexts[i], lm.SPREAD.take(symbols >> 3), i, 12, layout.hash_bits, layout.range_bits), axis=1)
        for k, (pair, x) in enumerate(zip(both.tolist(), symbols.tolist(), strict=True)):
            raw = b"".join(int(table[c]).to_bytes(8, "little") if int(table[c]) >> 56 == int(contexts[i][k]) & 255 else bytes(8) for c in pair)
            assert got[i, k].tolist() == [int(v) for v in np.frombuffer(raw, dtype=np.int8)[lm.PLACES[x]]]


def test_tokens_are_distinct_words_and_their_places():
    """Each text's words and one END in order, by brute force; a word is one Python object however often it is met."""
    from tickweave.llm import language_model as lm

    texts = [t.encode().lower() for t in ("", " ", "\n\x0b", "a", " a  B\t", "x\x1cy\x85z　日本 é\x00", "a\r\x0ca", "w" * 5000 + " w", *(a or "" for a in AWKWARD), "the same words " * 20000)]
    words, token, start = lm._tokens(texts)
    distinct = words.to_pylist()
    got = [[distinct[i] for i in part] for part in np.split(token, start[1:])]
    assert got == [[*t.split(), lm.END] for t in texts] == [[*re.findall(rb"[^\x20\x09-\x0D]+", t), lm.END] for t in texts]
    assert len(distinct) == len(set(distinct)) < 200
    assert [len(x) for x in lm._tokens([])] == [0, 0, 0]


def test_words_are_summed_without_an_object_each(monkeypatch):
    """Partial counts are merged as they come, and no count is lost when more words are met than are held."""
    from tickweave.llm import language_model as lm

    monkeypatch.setattr(lm, "MOST_WORDS", 50)
    counts, want, got, most = lm.WordCounts(), Counter(), Counter(), 0
    for i in range(60):
        raw = [f"w{j} w{j * j} {i % 7}".encode() for j in range(i, i + 5)]
        distinct, token, _ = lm._tokens(raw)
        counts.add(distinct, np.bincount(token))
        want.update(w for r in raw for w in [*r.split(), lm.END])
        most = max(most, counts.size)
        if counts.full() or i == 59 and counts.held:
            words, n = counts.end()
            got.update(dict(zip(words.to_pylist(), n.tolist(), strict=True)))
    assert got == want and most <= 2 * 50 + 20


def test_cells_hold_the_log_odds_of_their_owners():
    """Filled by one count of all choices; held against a plain walk over the keys."""
    from tickweave.llm import language_model as lm

    r = np.random.default_rng(5)
    layout, bits = lm.Layout(1), 14
    size, low = 1 << bits - layout.range_bits, layout.hash_bits - layout.range_bits
    for order in range(lm.INPUTS):
        h = 3 << low | r.integers(0, 1 << low, 300)[r.integers(0, 300, 2000)]
        keys, n = np.unique(order << 56 | h << 8 | r.integers(0, 64, 2000), return_counts=True)
        met, counts = Counter(), Counter()
        for key, c in zip(keys.tolist(), n.tolist(), strict=True):
            own, x = key >> 8 & (1 << layout.hash_bits) - 1, key & 63
            cells = lm.cells_of(np.array([own]), lm.SPREAD[[x >> 3]], order, bits, layout.hash_bits, layout.range_bits)
            for half in (0, 1):
                user = int(cells[half][0]) & size - 1, own, half, x >> 3 if half else None
                met[user] += c
                for j in range(3 * half, 3 * half + 3):
                    counts[user, int(lm.PLACES[x, j]) - lm.CELL * half, int(lm.BITS[x, j])] += c
        most = Counter()
        for user, c in met.items():
            most[user[0]] = max(most[user[0]], c)
        cells = lm._filled(keys, n, order, bits, layout).reshape(-1, lm.CELL).tolist()
        for at, cell in enumerate(cells):
            users = [u for u, c in met.items() if u[0] == at and c == most[at]]
            made = [[*(int(lm._quantized(np.float64(counts[u, k, 0]), np.float64(counts[u, k, 1]))) for k in range(lm.NODES)), int(np.uint8(u[1] & 255).view(np.int8))] for u in users]
            assert cell in made if users else cell == [0] * lm.CELL
