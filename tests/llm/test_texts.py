"""Operators on documents, on small hand-made tables and against plain versions."""

import base64
import hashlib
import itertools
import random
import re
import zlib
from array import array

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, language, minhash, packing, pii, quality, secrets, sketch
from tessera.llm.components import components
from tessera.llm.shingles import mix, shingle_sets

WORDS = {
    "en": "the of and ing er th on ou that with".split(), "fr": "le des éau qui ère ment çon une est tion".split(), "de": "der und ung sch ein äch keit über ß ist".split(),
}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, lang="en", n=40):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(WORDS[lang]) for _ in range(n))


def documents(spark, texts, extra=True):
    """Documents with columns whose names clash with those the operators make."""
    rows = [(i, t, "en", "src0", None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for c in ("score", "n_tokens", "piece", "digest", "bucket", "row", "spans", "component_id", "kept", "class", "node", "length", "rank"):
            df = df.withColumn(c, F.lit("x"))
    return df


ODD = [None, "", " ", "\n\n", "a", "a b c d", "A B  c\td", "é" * 50, "x" * 30000, "word " * 9000, "a b c d", "🙂 ½ \x1c\x85 don't I'LL 12 3", "line\n" * 300]


# --- tokens


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def fuzzed(seed, n=300):
    rng = random.Random(seed)
    pool = [chr(i) for i in range(0x180)] + list("你好🙂Ⅷ 　") + [" ", "\n", "  ", "'s", "'ll", "the ", "ing"]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_bpe_equals_tiktoken_and_decodes(spark, tiktoken_encoding):
    import public_tokenizers as P

    texts = ODD + fuzzed(1)
    found = bpe.encode_documents(documents(spark, texts), bpe.vocabulary("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=True)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        ids = np.asarray(tiktoken_encoding.encode_ordinary(text or ""), "<u4")
        r = rows[i]
        assert r.n_tokens == len(ids) and bytes(r.ids) == ids.tobytes() and bytes(r.decoded) == (text or "").encode()
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest() and r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_of_an_empty_table(spark):
    import public_tokenizers as P

    assert bpe.encode_documents(documents(spark, []), bpe.vocabulary("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_packing_ids_equal_tokenizers():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    encode = packing.encoder(P.path("byte_bpe_50k.json"), P.PATTERN)
    every = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x20000, 7)]]
    texts = [t or "" for t in ODD] + fuzzed(2, 800) + ["<|endoftext|> x"] + ["a".join(every[k : k + 50]) + " ".join(every[k : k + 50]) for k in range(0, len(every), 50)]
    names = []
    for piece in packing.vocabulary_bytes(tokenizer.get_vocab(with_added_tokens=False)):
        try:
            names.append(piece.decode())
        except UnicodeDecodeError:
            pass
    for text, known in zip(texts + names, tokenizer.encode_batch_fast(texts + names, add_special_tokens=False), strict=True):
        assert encode(text).tolist() == known.ids


def test_packing_gives_added_tokens_their_ids(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tokenizer, mark = Tokenizer.from_file(P.path("byte_bpe_50k.json")), "<|endoftext|>"
    texts = [f"a {mark} x", mark, mark * 2, f"a  {mark}\n\n b", f"<|{mark}|>", mark[:-1], *(mark.join(fuzzed(k, 4)) for k in range(60))]
    known = [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert known[0] == [64, 220, 50256, 2124]
    encode = packing.encoder(P.path("byte_bpe_50k.json"), P.PATTERN)
    assert [encode(text).tolist() for text in texts] == known
    rows = {r.doc_id: r for r in packing.pack_documents(documents(spark, texts)).where("piece = 0").collect()}
    assert all(rows[i].ids_crc32 == zlib.crc32(np.asarray([*ids, 0], "<u4").tobytes()) for i, ids in enumerate(known) if len(ids) < 2048)


@pytest.mark.parametrize("run", [" ", "\n", "\t", "\r\n", "\u3000"])
def test_packing_of_long_white_space(run):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tokenizer, encode = Tokenizer.from_file(P.path("byte_bpe_50k.json")), packing.encoder(P.path("byte_bpe_50k.json"), P.PATTERN)
    many = run * (2_000_000 // len(run))
    for text in (many, f"a {many[:20_000]}<|endoftext|>b don't 12 é{many[:30_000]}", many[:9_999] + "x", many[:10_000] + "x" + many[:20_000] + "\n y"):
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_spreads_equal_rows(spark):
    rows = packing.pack_documents(spark.createDataFrame([(1, "a b c")] * 300, "doc_id long, text string")).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 300 and {r.length for r in rows} == {4}


def best_fit(lengths, capacity):
    """Bins that plain best-fit decreasing opens."""
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in free if r >= n]
        room = min(fits) if fits else capacity
        if fits:
            free.remove(room)
        free.append(room - n)
    return len(free)


@pytest.mark.parametrize("seed", range(8))
def test_plan_equals_plain_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 64])
    lengths = [min(capacity, 1 + int(rng.expovariate(1 / rng.choice([2, 6, 20])))) for _ in range(rng.choice([0, 1, 50, 400]))]
    histogram = {n: lengths.count(n) for n in lengths}
    slots = packing.plan(histogram, capacity)
    places = {}
    for k, (n, rank, first, offset) in enumerate(slots.tolist()):
        upto = slots[k + 1][1] if k + 1 < len(slots) and slots[k + 1][0] == n else histogram[n]
        for r in range(rank, upto):
            places.setdefault(first + r - rank, []).append((offset, n))
    assert sum(map(len, places.values())) == len(lengths) and len(places) == best_fit(lengths, capacity)
    for bin_ in places.values():
        at = 0
        for offset, n in sorted(bin_):
            assert offset == at
            at += n
        assert at <= capacity


def test_packing_places_every_piece(spark, tiktoken_encoding):
    texts = ODD + [ODD[9]] * 3
    rows = packing.pack_documents(documents(spark, texts)).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == list(range(len(texts)))
    for i, text in enumerate(texts):
        ids, at = [*tiktoken_encoding.encode_ordinary(text or ""), 0], 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == zlib.crc32(np.asarray(ids[at : at + r.length], "<u4").tobytes())
            assert k == 0 or r.length == 2048
            at += r.length
        assert at == len(ids) and len(by_doc[i]) == -(-len(ids) // 2048)
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))] and own[-1].offset + own[-1].length <= 2048
    assert packing.pack_documents(documents(spark, [])).count() == 0


# --- near duplicates


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def plain_components(sets, percent=85):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(sets))]


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_shingle_sets_equal_plain_sets():
    rng = random.Random(0)
    texts = ODD + [" ".join(rng.choice("a b C D e É".split()) for _ in range(rng.randint(0, 30))) + rng.choice(["", " ", "\x0b", "\n"]) for _ in range(300)]
    found, plain = shingle_sets(texts), [plain_set(t) for t in texts]
    assert [len(s) for s in found] == [len(s) for s in plain]
    for i in range(0, len(texts), 7):
        for j in range(len(texts)):
            assert len(np.intersect1d(found[i], found[j])) == len(plain[i] & plain[j])


def test_words_that_collide_as_polynomials_stay_apart(spark):
    """A Thue-Morse word and its complement have equal polynomial hashes modulo 2**64, whatever the base."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    one, other = ("".join(pair[b] for b in bits) for pair in ("ab", "ba"))
    texts = [f"{one} b c d e", f"{other} b c d e", one, other, " ".join([one] * 9), " ".join([other] * 9)]
    assert len({s.tobytes() for s in shingle_sets(texts)}) == 6
    rows = minhash.near_duplicates(documents(spark, texts)).collect()
    assert all(r.kept for r in rows)


def test_shingles_of_long_texts(monkeypatch):
    from tessera.llm import shingles

    text = " ".join(sentence(random.Random(3), n=2000).split() + ["x" * 300]) + "\x0b\n"
    whole = shingle_sets([text, "a", text])
    monkeypatch.setattr(shingles, "CHUNK", 100)
    monkeypatch.setattr(shingles, "CACHE", 3)
    assert all((a == b).all() for a, b in zip(whole, shingle_sets([text, "a", text]), strict=True))


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    close = []
    for size in (1, 3, 40, 2000):
        for _ in range(40):
            both = mix(rng.integers(0, 2**63, 2 * size, dtype=np.uint64))
            a, b = np.sort(both[: size + size // 2]), np.sort(both[size // 2 :])
            k = sketch.sketches([a, b])
            assert (k != np.uint64(2**64 - 1)).all()
            if size > 1:
                close.append((k[0] == k[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(close)) < 0.02 and np.abs(close).max() < 0.3
    assert sketch.sketches([]).shape == (0, 64)
    assert [sketch.rows_for(x) for x in (0.7, 0.8, 0.85, 1.0)] == [2, 3, 4, 63]


def test_components_of_chains_stars_and_pairs(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(40)]
    edges = spark.createDataFrame(chain + star + [(5000, 5001), (5001, 5000), (7, 7)], "a long, b long")
    groups = {}
    for r in components(edges).collect():
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, groups.values())) == [2, 41, 61] and all(root in g for root, g in groups.items())
    assert components(edges.limit(0)).count() == 0


@pytest.mark.parametrize(("block", "percent", "exact"), [(512, 85, False), (5, 85, False), (512, 80, False), (20, 80, True)])
def test_near_duplicates_equal_brute_force(spark, block, percent, exact):
    rng = random.Random(5)
    base = [f"x{rng.randrange(400)}" for _ in range(150)]
    texts = list(ODD) + [edited(rng, base, rng.randint(0, 5)) for _ in range(40)] + [" ".join(base)] * 6
    for _ in range(25):
        own = [f"y{rng.randrange(3000)}" for _ in range(rng.randint(5, 120))]
        texts += [" ".join(own), edited(rng, own, rng.randint(0, 3))]
    order = rng.sample(range(len(texts)), len(texts))
    texts = [texts[k] for k in order]
    rows = {r.doc_id: r for r in minhash.near_duplicates(documents(spark, texts), percent, block, exact).collect()}
    sets = [plain_set(t) for t in texts]
    assert [rows[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [rows[i].component_id for i in range(len(texts))] == plain_components(sets, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows.values())


def test_forest_connects_what_links():
    rng = random.Random(3)
    base = list(range(60))
    sets = []
    for _ in range(30):
        s = set(base)
        for _ in range(rng.randint(0, 6)):
            s.discard(rng.choice(base))
            s.add(rng.randrange(1000, 9999))
        sets.append(np.asarray(sorted(s), np.uint64))
    plain = plain_components([set(s.tolist()) for s in sets])
    for chosen in (sets, sets[:8]):
        root = list(range(len(chosen)))
        for i, j in minhash.forest(chosen, None):
            a, b = root[i], root[j]
            assert a != b
            root = [a if r == b else r for r in root]
        expected = plain_components([set(s.tolist()) for s in chosen])
        assert len(set(root)) == len(set(expected)) and all((root[i] == root[j]) == (expected[i] == expected[j]) for i in range(len(chosen)) for j in range(i))
    assert plain


def test_repeated_ids_nulls_and_empty_tables(spark):
    long = " ".join(f"w{k}" for k in range(30))
    rows = [(1, long, None, None, None), (1, long, None, None, None), (None, long, None, None, None), (1, "other words here", None, None, None), (2, None, None, None, None), (2, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    found = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in minhash.near_duplicates(df).collect())
    assert found == [("1", 1, "1", True), ("1", 26, "1", True), ("1", 26, "1", True), ("2", 0, "2", True), ("2", 0, "2", True), ("None", 26, "1", False)]
    kept = minhash.without_near_duplicates(df)
    assert kept.columns == df.columns and sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == [(1, "other words here"), (1, long)] and kept.count() == 3
    assert minhash.near_duplicates(df.limit(0)).count() == 0 and minhash.without_near_duplicates(df.limit(0)).count() == 0


def test_one_row_of_a_component_stays_whatever_its_ids(spark):
    words = [f"w{k}" for k in range(60)]
    near = [" ".join([*words, f"end{k}"]) for k in range(3)]
    others = [" ".join(f"{x}{k}" for k in range(60)) for x in "uv"]
    rows = [(1, t) for t in near] + [(None, t + " u0") for t in near] + [(None, others[0]), (None, others[0] + " x"), (7, others[1]), (7, others[1] + " x"), (8, others[1] + " y"), (9, None), (9, None)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    kept = minhash.without_near_duplicates(df).collect()
    assert sorted((str(r.doc_id), (r.text or "")[:2]) for r in kept) == [("1", "w0"), ("7", "v0"), ("9", ""), ("None", "u0")]


# --- language


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(7)
    rows = [(i, sentence(rng, lang, rng.randint(8, 60)), lang, "s", None) for i, lang in enumerate(rng.choice(list(WORDS)) for _ in range(400))]
    return spark.createDataFrame(rows, DOCS)


def test_backpropagation_equals_differences():
    model = language._start(["a", "b", "c"], 1)
    rng = np.random.default_rng(2)
    text, label = rng.integers(0, 6, (7, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    for name in ("table", "recur", "inner", "out", "bias"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    grads, _ = language._gradients(model, text, label)
    for name in ("table", "recur", "inner", "out", "bias"):
        values, found = getattr(model, name), getattr(grads, name)
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in values.shape)
            if name == "table":
                at = (at[0], int(rng.integers(0, 6)), at[2])
            old, step = values[at], 1e-5
            values[at] = old + step
            high = language._gradients(model, text, label)[1]
            values[at] = old - step
            low = language._gradients(model, text, label)[1]
            values[at] = old
            assert found[at] == pytest.approx((high - low) / (2 * step), abs=2e-4)


def test_predictor_equals_the_trained_network():
    model = language._start(["a", "b"], 3)
    text = np.random.default_rng(0).integers(0, 256, (4, 9)).astype(np.uint8)
    _, ahead = language._forward(model, 0, text.T)
    _, behind = language._forward(model, 1, text.T[::-1])
    logits = np.concatenate([ahead, behind[::-1]], axis=2) @ model.out + model.bias
    p = np.exp(logits) / np.exp(logits).sum(-1, keepdims=True)
    assert np.allclose(language.Predictor(model).positions(text), p, atol=1e-5)


def test_language_on_held_out_texts(spark, corpus):
    model = language.learn(corpus)
    rows = language.predict(corpus.where(language.fold("doc_id", 5) == 0), ["doc_id", "lang"], model).collect()
    assert len(rows) > 50 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.95 and all(0 <= r.score <= 1 for r in rows)
    odd = {r.doc_id: r for r in language.predict(documents(spark, ODD + ["12 345 !"]), ["doc_id"], model).collect()}
    assert len(odd) == len(ODD) + 1
    for i, text in enumerate([*ODD, "12 345 !"]):
        assert (odd[i].lang_pred == "und") == (not text or not any(c.isalpha() for c in text))
    one, two = (sorted(map(tuple, language.predict(corpus.select("doc_id", "text").repartition(n), ["doc_id"], model).collect())) for n in (1, 7))
    assert [r[:2] for r in one] == [r[:2] for r in two] and np.allclose([r[2] for r in one], [r[2] for r in two], atol=1e-5)


def test_the_language_stage_rejects_by_score(spark, corpus):
    """With three languages too, and short texts of them stay."""
    import corpus_pipeline

    rng = random.Random(3)
    noise = [" ".join("".join(rng.choice("bcdfghjklmnpqrstvwxzабвгдежзик") for _ in range(rng.randint(2, 9))) for _ in range(20)) for _ in range(100)]
    short = [sentence(rng, lang, 4) for lang in WORDS for _ in range(30)]
    rows = spark.createDataFrame([(1000 + i, t, None, "s", None) for i, t in enumerate(noise + short)], DOCS)
    kept = {r.doc_id for r in corpus_pipeline.language(spark, corpus.union(rows), "").select("doc_id").collect()}
    assert sum(1000 + i in kept for i in range(100)) < 10
    assert sum(1100 + i in kept for i in range(90)) >= 86 and sum(i in kept for i in range(400)) >= 396
    assert [round(corpus_pipeline.least_score(n), 4) for n in (1, 2, 4, 400)] == [0.65, 0.5333, 0.44, 0.3017]
    # nothing can be judged without a language: texts with a letter stay
    bare = corpus.withColumn("lang", F.lit(None).cast("string")).limit(5).union(spark.createDataFrame([(9000, "1 2", None, None, None), (9001, None, None, None, None)], DOCS))
    assert corpus_pipeline.language(spark, bare, "").count() == 5


@pytest.mark.parametrize("left", list(WORDS))
def test_the_language_stage_rejects_a_language_that_it_never_saw(spark, corpus, left):
    import corpus_pipeline

    docs = corpus.withColumn("lang", F.when(F.col("lang") == left, None).otherwise(F.col("lang")))
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, "").select("doc_id").collect()}
    sizes = {(r.lang == left): [] for r in corpus.collect()}
    for r in corpus.collect():
        sizes[r.lang == left].append(r.doc_id in kept)
    assert np.mean(sizes[True]) < 0.15 and np.mean(sizes[False]) > 0.98


def test_every_language_is_learned(spark):
    rows = [(2 * i + k, f"word{k} of language {i}", f"l{i}", "s", None) for i in range(450) for k in range(2)]
    found = language.sample(spark.createDataFrame(rows, DOCS))
    assert len({lang for _, lang in found}) == 450 and len(language.train(found, steps=1).languages) == 450


def test_language_without_labels(spark):
    docs = documents(spark, ["abc", None]).withColumn("lang", F.lit(None).cast("string"))
    assert [r.lang_pred for r in language.predict(docs, ["doc_id"], language.learn(docs)).collect()] == ["und", "und"]
    assert language.predict(docs.limit(0), ["doc_id"], language.learn(docs.limit(0))).count() == 0


# --- quality


def graded(rng):
    good = [". ".join(sentence(rng, n=9).capitalize() for _ in range(2)) + "." for _ in range(4)]
    bad = [" ".join(w.upper() + "!!" for w in sentence(rng, n=9).split()) for _ in range(4)]
    return "\n".join(good), "\n".join(bad)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    counts = np.asarray([1, 4, 2, 5])
    evidence, ties = rng.normal(size=counts.sum()), rng.normal(size=(2, 2))
    good, pairs, total = quality.marginals(evidence, ties, counts)
    at = 0
    for k, n in enumerate(counts):
        e = evidence[at : at + n]
        paths = [[(m >> i) & 1 for i in range(n)] for m in range(2**n)]
        score = np.asarray([sum(e[i] * p[i] for i in range(n)) + sum(ties[a, b] for a, b in zip(p, p[1:], strict=False)) for p in paths])
        weight = np.exp(score - np.logaddexp.reduce(score))
        assert total[k] == pytest.approx(np.logaddexp.reduce(score))
        assert np.allclose(good[at : at + n], [sum(w for w, p in zip(weight, paths, strict=True) if p[i]) for i in range(n)])
        for a in (0, 1):
            for b in (0, 1):
                expected = sum(w * sum((p[i], p[i + 1]) == (a, b) for i in range(n - 1)) for w, p in zip(weight, paths, strict=True))
                assert pairs[k, a, b] == pytest.approx(expected)
        at += n


def test_log_odds_give_the_marginals(monkeypatch):
    rng = np.random.default_rng(5)
    for few in (1, 3, 8, 100):
        monkeypatch.setattr(quality, "FEW", few)
        counts = rng.integers(1, 30, size=12)
        evidence, ties = rng.normal(size=counts.sum()) * 5, rng.normal(size=(2, 2))
        assert np.allclose(quality.good_lines(evidence, ties, counts), quality.marginals(evidence, ties, counts)[0])
    assert np.isfinite(quality.good_lines(np.asarray([1e4, -1e4, 1e4]), ties, np.asarray([3]))).all()


def test_scores_do_not_depend_on_the_blocks(monkeypatch):
    rng = np.random.default_rng(6)
    model = quality.Model(rng.normal(size=3 * quality.OWN + 2), rng.normal(size=(2, 2)), 1.5, 0.1)
    texts = [*ODD, "a b\nc c c\n\na b\n" * 40]
    plain = []
    for text in texts:  # through the whole matrix of features
        monkeypatch.setattr(quality, "TRAIN_LINES", 10**6)
        x, lengths, counts = quality.line_features([text])
        good = quality.marginals(x @ model.weights, model.ties, counts)[0]
        plain.append(1 / (1 + np.exp(-(model.slope * quality._logit(quality.pooled(good, lengths, counts)) + model.shift))))
    for lines, characters in ((20_000, 1 << 20), (3, 5)):
        monkeypatch.setattr(quality, "LINES", lines)
        monkeypatch.setattr(quality, "CHARACTERS", characters)
        assert np.allclose(quality.score_texts(model, texts), np.concatenate(plain), atol=1e-4)
    # lines of a window have the features that they have in the whole text
    long = "\n".join(f"w{i % 50} x{i}" * (i % 7) for i in range(500))
    whole = quality.line_features([long])[0]
    monkeypatch.setattr(quality, "TRAIN_LINES", 96)
    some, _, counts = quality.line_features([long, "a"])
    assert counts.tolist() == [96, 1] and any((whole[k : k + 96] == some[:96]).all() for k in range(405))


def test_quality_of_many_lines():
    import time

    model = quality.Model(np.zeros(3 * quality.OWN + 2), np.zeros((2, 2)), 1.0, 0.0)
    began = time.process_time()
    assert quality.score_texts(model, ["\n" * 1_000_000]).tolist() == [0.5]
    assert time.process_time() - began < 60


def test_quality_on_held_out_texts(spark):
    rng = random.Random(9)
    texts = [t for _ in range(150) for t in graded(rng)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, (i + 1) % 2, 0) for i in range(len(texts))] + [(None, 1, 0), (3, None, 0), (5, 7, 0)], "doc_id long, quality int, toxic int")
    model = quality.learn(docs, labels)
    rows = quality.score(docs.withColumn("out", quality.fold("doc_id", 3) == 1), ["doc_id", "out"], model).where("out").collect()
    assert len(rows) > 50 and np.mean([r.predicted == (r.doc_id + 1) % 2 for r in rows]) > 0.97
    odd = quality.score(documents(spark, ODD), ["doc_id", "text"], model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in odd)
    assert [r.score for r in quality.score(docs.limit(3), ["doc_id"], quality.learn(docs, labels.where("quality = 1"))).collect()] == [0.5] * 3
    assert quality.score(docs.limit(0), ["doc_id"], model).count() == 0 and quality.learn(docs.limit(0), labels) is None


# --- personal data


def plain_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(5)
    for _ in range(6000):
        text = "".join(rng.choice("ab.@-+_ 0123 () 49x.%é\n") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == plain_base(text)


def test_field_finds_held_out_examples():
    w, hit, extra, missed = pii.weights(), 0, 0, 0
    for text, gold in pii._examples(200, 77):
        found = set(pii.all_spans(text, w)[1])
        hit, extra, missed = hit + len(found & set(gold)), extra + len(found - set(gold)), missed + len(set(gold) - found)
    assert hit / (hit + extra) > 0.9 and hit / (hit + missed) > 0.95


@pytest.mark.parametrize("address", [
    "john.doe [at] mail [dot] example [dot] com", "jane [at] mail [dot] example [dot] co [dot] uk", "j.r.smith (at) cs.dept.uni-example.ac.uk",
    "jane [at] research-department [dot] some-long-university [dot] edu", "first.middle.van.last [at] a-b [dot] mail [dot] c-d-e [dot] dept [dot] example [dot] ac [dot] uk",
])
def test_spelled_addresses_are_found_whole(address):
    text = f"write to {address}, or come on 2024-02-03"
    assert (9, 0, 9 + len(address)) in pii.all_spans(text, pii.weights())[1]
    low, high = next(r for r in pii._regions(text) if r[0] <= 9 < r[1])
    assert (9, 9 + len(address)) in [s[2:] for s in pii._candidates(text, low, high, *pii._tokens(text, low, high))]


def plain_candidates(text, low, high):
    """Segments of a region by trying all pairs of tokens."""
    tokens = [(m.start(), m.end()) for m in pii._TOKEN.finditer(text, low, high)]
    marks = {m.start() for m in pii._TRIGGER.finditer(text, low, high)}
    starts, whole, out = {a for a, _ in tokens}, set(), set()
    for a, after in pii._addresses(text, low, high):
        while a < after[0] and not (a in starts and text[a].isalnum()):
            a += 1
        whole |= {(a, b) for b in after}
    for i, (a, _) in enumerate(tokens):
        for j in range(i, len(tokens)):
            b = tokens[j][1]
            full = [t for t in tokens[i : j + 1] if not text[t[0] : t[1]].isspace()]
            live = [t for t in full if any(k in marks for k in range(*t))]
            if (a, b) in whole and text[a].isalnum() and text[b - 1].isalnum():
                out.add((a, b))
            fits = len(full) <= pii.MOST and 7 <= b - a <= pii.LONGEST and live and not text[a].isspace() and text[a] not in ",;:!?])}'\"" and text[b - 1].isalnum()
            weight = sum(t[1] - t[0] for t in live)
            if fits and ("@" in text[a:b] or "at" in text[a:b] or (4 if text.count(".", a, b) >= 3 else 7) <= weight <= pii.DIGITS):
                out.add((a, b))
    return out


def test_candidates_equal_all_pairs(monkeypatch):
    rng = random.Random(4)
    parts = ["12", "4111 ", " ", "x", "ab ", "@", "a@b.c ", " [at] ", " [dot] ", ".", "-", "(", ")", "at", "é1", "12345678901234567890 "]
    for block in (4096, 45):
        monkeypatch.setattr(pii, "BLOCK", block)
        for _ in range(60):
            text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 90)))
            for low, high in pii._regions(text):
                found = [s[2:] for s in pii._candidates(text, low, high, *pii._tokens(text, low, high))]
                assert len(found) == len(set(found)) and set(found) == plain_candidates(text, low, high)


def test_best_segments_equal_enumeration():
    rng = random.Random(6)
    for _ in range(100):
        segments = [(i, i + rng.randint(1, 4), k % 4, rng.uniform(0.1, 3), 10 * i, 10 * i + 1) for k, i in enumerate(rng.randrange(8) for _ in range(rng.randint(1, 9)))]
        subsets = (sorted(s for k, s in enumerate(segments) if n >> k & 1) for n in range(1, 2 ** len(segments)))
        plain = max(sum(s[3] for s in some) for some in subsets if all(a[1] <= b[0] for a, b in itertools.pairwise(some)))
        scores = {}
        for s in segments:
            scores[s[4], s[2], s[5]] = max(s[3], scores.get((s[4], s[2], s[5]), 0))
        found = list(pii._best([array(t, c) for t, c in zip("qqqdqq", zip(*segments))]))
        assert sum(scores[s] for s in found) >= plain - 1e-9


#: Written by hand, in forms that the generated sentences need not have.
SHOWN = [
    ("Please write to anna.schmidt (at) uni-koeln.de before Monday.", "anna.schmidt (at) uni-koeln.de"), ("Mail: bob [at] startup [dot] io", "bob [at] startup [dot] io"),
    ("reach me @ carla @ post.example.org today", "carla @ post.example.org"), ("Call (415) 555-0132 after six", "(415) 555-0132"), ("tel. 212-555-0187, room 4", "212-555-0187"),
    ("my mobile: 06 12 34 56 78", "06 12 34 56 78"), ("fax 1-800-555-0199", "1-800-555-0199"), ("card 4111.1111.1111.1111 exp 12/27", "4111.1111.1111.1111"),
    ("paid by visa 4012 - 8888 - 8888 - 1881 yesterday", "4012 - 8888 - 8888 - 1881"), ("host 192[.]168[.]10[.]21 is down", "192[.]168[.]10[.]21"),
    ("The number is 646.555.0142 and nothing else", "646.555.0142"), ("schreib an j.meier [at] web [dot] de bitte", "j.meier [at] web [dot] de"),
]
CLEAN = [
    "IBAN DE89 3704 0044 0532 0130 00 for the transfer", "ISBN 978-3-16-148410-0 second edition", "the meeting of 2024-05-17 at 14:30:00", "total of 1,234,567.89 euro",
    "version 10.4.2.1-beta was released", "order 4567 8901 of 12/11/2023", "lat 52.5200 lon 13.4050", "between 1914 and 1918, 1939 and 1945", "serial 0123456789abcdef01234567",
    "look at 17 (at least) of 24", "pages 120-135, 140-152", "GB29 NWBK 6016 1331 9268 19", "score 21 - 14 - 7 - 3", "see section 3.2.1.4 of the report", "room 1024, floor 3", "EAN 4006381333931",
]


def test_field_on_sentences_written_by_hand():
    w = pii.weights()
    spans = lambda text: [text[a:b] for a, _, b in pii.all_spans(text, w)[1]]
    assert sum(value in spans(text) for text, value in SHOWN) >= 0.8 * len(SHOWN)
    assert sum(not spans(text) for text in CLEAN) >= 0.8 * len(CLEAN)


def test_pii_of_long_dense_texts():
    """Texts without a break cost by their length."""
    import time

    w = pii.weights()
    for piece in ("1234 5678 9012 3456 ", "7 ", "a1 b2 c3. ", "12345678901234567890", "a@b.c "):
        took = []
        for n in (10_000, 40_000):
            text = piece * (n // len(piece))
            began = time.process_time()
            pii.all_spans(text, w)
            took.append(time.process_time() - began)
        assert took[1] < 8 * took[0] + 0.5


def test_lattice_equals_enumeration():
    segments = [(0, 2, 0, 0), (1, 3, 0, 0), (2, 4, 0, 0), (0, 4, 0, 0)]
    scores = np.asarray([[0.5, 0.1], [1.0, -1], [0.2, 0.3], [2.0, 0.0]])
    ahead, behind = pii._lattice(4, segments, scores)

    def paths(t):
        if t == 4:
            return [0.0]
        return paths(t + 1) + [s + p for k, x in enumerate(segments) if x[0] == t for s in scores[k] for p in paths(x[1])]

    assert ahead[4] == pytest.approx(np.logaddexp.reduce(paths(0))) and behind[0] == pytest.approx(ahead[4])


def test_pii_rows(spark):
    texts = [*ODD, "mail a.b@c.example.com or +1 (988) 555-2485 4709559030084884, host 10.0.0.1 é 300.1.1.1", "tel (555) 123-4567 x"]
    rows = {r.doc_id: r for r in pii.find(documents(spark, texts), ["doc_id"]).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        base = plain_base(text or "")
        assert rows[i].base_sha256 == hashlib.sha256(pii.spell(base).encode()).hexdigest()
        assert set(filter(None, pii.spell(base).split(","))) <= set(rows[i].spans.split(","))
    r = rows[len(ODD)]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 0, 0)  # the phone's digits run on into the card's
    assert r.spans == "email:5:22,phone:26:43,card:44:60,ip:67:75"
    assert rows[len(ODD) + 1].spans == "phone:4:18"
    clean = {r.doc_id: r.text for r in pii.redact(documents(spark, texts), ["doc_id"]).collect()}
    assert clean[len(ODD)] == "mail [EMAIL] or [PHONE] [CARD], host [IP] é 300.1.1.1" and clean[0] is None and [clean[i] for i in range(len(ODD))] == ODD
    assert pii.find(documents(spark, []), ["doc_id"]).count() == 0
    assert pii.redacted("abcdef", [(1, 0, 3), (2, 1, 4)]) == "a[EMAIL]ef"


# --- secrets

BASE = [r"(?i:(?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", r"AKIA[A-Z0-9]+", r"[0-9a-f]+"]


def plain_secrets(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(BASE[0], text, re.ASCII) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(BASE[1], text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(BASE[2], text) if len(m[0]) >= 24])


def test_secrets(spark):
    rng = random.Random(8)
    parts = ["password", "Token", "api_key", "APIKEY", "=", ":", '"', " ", "AKIA", "ABCDEFGHIJ0123456789", "deadbeef01" * 3, "secret=abc", "é", "\n", "x", "'abcdef'", "_-", "AKIAAKIA"]
    texts = [*ODD, *("".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(300))]
    live, shared = "Zx8Qp2Lm9Kv4Rt7Wy1Nb", "Aa1Bb2Cc3Dd4Ee5Ff6Gg"
    texts += [f"key {live} here", f"see {shared}", f"see {shared} é", f"and {shared}"]
    n = len(texts)
    docs = documents(spark, texts).withColumn("source", F.when(F.col("doc_id") >= n - 3, F.concat(F.lit("o"), F.col("doc_id").cast("string"), F.lit("/r"))).when(F.col("doc_id") % 9 == 0, None).otherwise(F.lit("mine/repo")))
    rows = {r.doc_id: r for r in secrets.secrets(docs).collect()}
    assert len(rows) == n
    for i, text in enumerate(texts):
        base = plain_secrets(text)
        spelled = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert rows[i].base_sha256 == hashlib.sha256(spelled.encode()).hexdigest(), text
        assert (rows[i].n_assign, rows[i].n_access, rows[i].n_hex) == tuple(sum(s[1] == k for s in base) for k in range(3))
        assert set(filter(None, spelled.split(","))) <= set(rows[i].spans.split(","))
    assert rows[n - 4].spans == "opaque:4:24" and rows[n - 4].n_live == 1
    assert [rows[n - k].spans for k in (1, 2, 3)] == [""] * 3 and rows[n - 1].n_copied == 1
    assert secrets.secrets(docs.limit(0)).count() == 0


def test_secret_rows_repeat(spark):
    docs = spark.createDataFrame([(1, "token = abcdef1", "a"), (1, "token = abcdef1", "a"), (None, "token = abcdef1", None)], "doc_id long, text string, source string")
    assert [r.spans for r in secrets.secrets(docs).collect()] == ["assign:0:15"] * 3


def test_secrets_of_many_matches(spark):
    """Runs of matches are folded apart; positions hold over their borders, and opaque runs beside base spans stay whole."""
    run = "0123456789abcdef01234567"
    texts = [" ".join([run] * n) for n in (1, 127, 128, 129, 256, 1000)] + [f"token={run} é" * 300, "Ab1" * 10 + " " + f"{run}-Zz9 Kk1{run} x " * 200, f"{run} " * 100_000]
    rows = {r.doc_id: r for r in secrets.secrets(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        base = plain_secrets(text)
        opaque = [(m.start(), 3, m.end()) for m in re.finditer(r"[A-Za-z0-9_-]{20,}", text) if all(re.search(c, m[0]) for c in ("[a-z]", "[A-Z]", "[0-9]"))]
        opaque = [s for s in opaque if not any(a < s[2] and s[0] < b for a, _, b in base)] if len(base) < 10_000 else []
        assert rows[i].base_sha256 == hashlib.sha256(",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base).encode()).hexdigest()
        assert rows[i].spans == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(base + opaque))
