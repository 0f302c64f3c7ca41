import hashlib
import inspect
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import embeddings, language, lm, minhash, pii, quality, queries, secrets, sentencepiece_bpe, urls
from ledgerline.llm.components import components, local_components

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(None, None, "a", 1), (1, None, "a", 1), (2, "", None, 2), (3, "é𠮷 token=token:abcdefg PASSWORD = 'abcdef' x", "en", 3), (4, "word " * 30_000, "en", 4), (4, "word " * 30_000, "en", 4), (5, "x" * 50_000, "de", 5), (6, " \n\t ", "de", 6)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, sketches long")


# components


def test_components_equal_union_find(spark):
    draw = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 120, (90, 2))] + [(200 + i, 201 + i) for i in range(40)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {v: find(v) for v in parent}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# op1


@pytest.fixture(scope="module")
def piece_encoder():
    return sentencepiece_bpe.Encoder(queries.vocabulary("piece_bpe_32k.model"))


def test_pieces_equal_the_library(piece_encoder, texts):
    from sentencepiece import SentencePieceProcessor

    own = SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
    draw = np.random.default_rng(1)
    alphabet = list("abcdehilmnorst .,▁\n<>éü日𠮷0")
    cases = [*list(texts.values())[:200], " a", "  a b  ", "\ta\nb", "ﬁ½ Å", "", "a▁b", "<s>a</s>", "\x00", "ab" * 500, "a" * 48, "a" * 49, " " * 100 + "b"]
    cases += ["".join(draw.choice(alphabet, draw.integers(1, 200))) for _ in range(200)]
    ids, offsets = piece_encoder(cases)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == own.encode(cases)
    assert piece_encoder.decode(ids, offsets) == [own.decode(x) for x in own.encode(cases)]


def test_pieces_round_trip(spark, odd, piece_encoder):
    path = queries.vocabulary("piece_bpe_32k.model")
    back = {(r.doc_id, r.text) for r in sentencepiece_bpe.decode(sentencepiece_bpe.encode(odd, path), path).collect()}
    assert back == {(r.doc_id, r.text or "") for r in odd.collect()}
    assert all(r.restored for r in sentencepiece_bpe.digest(odd, path).collect())
    assert sentencepiece_bpe.digest(odd.limit(0), path).count() == 0


# op2


def test_url_rules_equal_brute_force(spark):
    hosts = ["com", "example.com", "a.example.com", "notexample.com", "net", "example.net", "x.org", "ORG"]
    paths = ["", "/", "/en/", "/en/7", "/en/75/casino", "/de/8", "/de/9?x=/en/", "/es/#a", "/poker-history/poker"]
    addresses = [None, "", "no scheme", "://", *(f"http://{h}{p}" for h in hosts for p in paths)]
    pages = spark.createDataFrame(list(enumerate(addresses)), "page_id long, url string")
    for r in urls.filter_urls(pages).collect():
        host, path = urls.split_url(addresses[r.page_id])
        fits = [(len(n), n, a) for a, n in urls.HOST_RULES if (host == n.split("/")[0] or host.endswith("." + n.split("/")[0])) and path.startswith(n[n.index("/") :])]
        assert (r.host, r.path) == (host, path)
        if fits:
            assert (r.rule, r.verdict) == max(fits)[1:]
        else:
            assert r.rule is None and r.verdict in ("allow", "block")
    assert urls.filter_urls(pages.limit(0)).count() == 0


# op3


def test_languages_are_told_apart(docs, odd):
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.identify(docs).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(odd).collect()}
    assert got[1] == got[2] == got[6] == ("und", 0.0)
    assert language.keep_identified(odd).columns == odd.columns


@pytest.fixture
def one_id(spark):
    words = {"en": "the house of and with this", "de": "der haus und mit dieser nicht"}
    rows = [(None if lang == "en" else 8, lang, " ".join(w + chr(97 + k) for w, k in zip(draw.choice(words[lang].split(), 60), draw.integers(0, 26, 60)))) for draw in [np.random.default_rng(6)] for lang in words for _ in range(1500)]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)


def test_samples_stay_bounded_with_one_id(spark, one_id, monkeypatch):
    taken = []
    monkeypatch.setattr(language, "fit", lambda texts, labels: taken.append(Counter(labels)))
    language.learn(one_id)
    assert taken == [{"en": 400, "de": 400}]
    sizes = []
    grow = quality.IsolationForest
    monkeypatch.setattr(quality, "IsolationForest", lambda rows: sizes.append(len(rows)) or grow(rows))
    quality.calibrate(one_id, spark.createDataFrame([(8, 1), (None, 1)], "doc_id long, quality int"), sample_rows=100)
    assert sizes and sizes[0] <= 100


# op4


def test_quality_statistics_equal_brute_force(texts):
    sample = [*list(texts.values())[:150], None, "", "a b c a b c", "x\nx\n\n x\nx"]
    stats = quality.statistics(sample)
    for i, text in enumerate(sample):
        words = WORD.findall(text or "")
        windows = Counter(zip(words, words[1:], words[2:]))
        repeated = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated))
        assert tuple(int(stats[n][i]) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want


def test_quality_verdicts(spark, docs, sf_dir, odd):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality.judge_quality(docs, labels).collect()
    assert not any(r.kept and r.base_failed for r in rows) and np.mean([r.kept or r.base_failed for r in rows]) > 0.9
    assert quality.judge_quality(odd, labels.limit(0)).count() == odd.count()


# op5


def brute_scores(rows):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    training = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 != 1
    tokens = [(i, [*WORD.findall(lower(t or "")), None]) for i, t in rows]
    seen = Counter(x for i, w in tokens if training(i) for x in w)
    total = sum(seen.values())
    base = lambda x: math.log10((seen[x] + 0.5) / (total + 0.5 * (len(seen) + 1)))
    return {i: (not training(i), len(w), sum(seen[x] > 0 for x in w), total, sum(map(base, w))) for i, w in tokens}


@pytest.mark.parametrize("block_chars", [200_000, lm.BLOCK_CHARS])
def test_language_model_scores(docs, texts, block_chars):
    want = brute_scores(texts.items())
    rows = lm.score(docs, block_chars=block_chars).collect()
    for r in rows:
        assert tuple(r)[1:5] == want[r.doc_id][:4] and math.isclose(r.base_score, want[r.doc_id][4], abs_tol=1e-6)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_edge_cases(odd):
    assert [r.n_tokens for r in lm.score(odd).collect() if r.doc_id in (1, 2, 6)] == [1, 1, 1]
    assert lm.score(odd.limit(0)).count() == 0


def test_scores_use_every_ngram(docs, texts):
    bound = {"most_bits": 1 << 12} if "most_bits" in inspect.signature(lm.score).parameters else {}
    made = {i: lm.tokens([t])[0] for i, t in texts.items()}
    pairs_of = {i: lm.pair_hash(lm.firsts(x, np.array([0, len(x)])), x).tolist() for i, x in made.items()}
    seen, pairs = Counter(), Counter()
    for i, x in made.items():
        if lm.is_training(i):
            seen.update([int(lm.START), *x.tolist()])
            pairs.update(pairs_of[i])
    total, kinds = sum(seen.values()) - seen[int(lm.START)], len(seen) - 1
    count = lambda n: lm.level_counts(lm.levels(np.array(n)))
    near = []
    for r in lm.score(docs, **bound).collect():
        x = made[r.doc_id].tolist()
        word, first, pair = count([seen[w] for w in x]), count([seen[w] for w in [int(lm.START), *x[:-1]]]), count([pairs[p] for p in pairs_of[r.doc_id]])
        chance = lm.PAIR * np.minimum(1, pair / np.maximum(first, 1)) + (1 - lm.PAIR) * np.minimum(1, (word + 0.5) / (total + 0.5 * (kinds + 1)))
        near.append(abs(r.score - np.log10(chance).sum()) / len(x))
    assert np.median(near) < 0.15 and np.mean(near) < 0.2


def test_filter_levels():
    keys, counts = np.arange(1, 5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.arange(1, 5000)
    filled = lm.Filter([lm.make_slice(keys, counts, 1 << 24)])
    assert (filled.levels(keys) >= lm.levels(counts)).all() and np.mean(filled.levels(keys) == lm.levels(counts)) > 0.9
    assert np.mean(filled.levels(keys + np.uint64(1)) > 0) < 0.1
    small = lm.make_slice(keys, counts, 1 << 12)
    assert 8 * len(small) <= 1 << 12


# op6


def brute_spans(text):
    text, out = text or "", []
    rules = [re.compile(secrets.RULES["assign"], re.ASCII), re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")]
    for kind, rule in enumerate(rules):
        for m in rule.finditer(text):
            if (len(m[2]) >= 6) if kind == 0 else len(m[0]) >= (20, 24)[kind - 1]:
                out.append((m.start(), kind, m.end()))
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_secret_spans_equal_brute_force(spark, docs, texts, odd):
    model = secrets.default_model(spark)
    for source, of in ((docs, texts), (odd, {r.doc_id: r.text for r in odd.collect()})):
        for r in secrets.scan(source, model).collect():
            base = brute_spans(of[r.doc_id])
            assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
            assert (r.n_assign, r.n_access, r.n_hex) == tuple(base.count(k + ":") for k in ("assign", "access", "hex"))
            assert {x for x in r.spans.split(",") if not x.startswith("random")} - {""} == set(base.split(",")) - {""}
    assert secrets.scan(odd.limit(0), model).count() == 0


def test_random_strings_against_identifiers(spark):
    words = ["x7Gh2kLpQz9wVb4nMr8TyU", "getUserAccountSettingsById", "MAX_CONNECTION_POOL_SIZE_2", "unconstitutionally/reestablished", "=" * 30, "a" * 30]
    rows = secrets.scan(spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")).collect()
    assert [r.n_random for r in sorted(rows)] == [1, 0, 0, 0, 0, 0]


def test_redacted_texts_hold_no_secret(docs, texts):
    rows = secrets.redact(docs).collect()
    assert len(rows) == len(texts) and not any(brute_spans(r.text) for r in rows)
    assert all(r.text == texts[r.doc_id] for r in rows if not brute_spans(texts[r.doc_id]))


# op7


def test_vector_links_equal_brute_force(spark, sf_dir):
    draw = np.random.default_rng(2)
    base = draw.standard_normal((60, 64))
    rows = [(i, [float(x) for x in base[i % 60] + (i // 60) * 0.12 * draw.standard_normal(64)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(90)] + [(2000, None), (2001, []), (2002, [0.0] * 64), (2003, [float("nan")] * 64), (None, rows[0][1]), (2004, [1.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=32).collect()}
    some = [(i, v) for i, v in rows if i is not None and i < 2000]
    x = np.array([v for _, v in some])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    ids = [i for i, _ in some]
    label = local_components(len(ids), *np.nonzero(near))
    assert np.mean([got[i][:2] == (int(near[k].sum()), ids[label[k]]) for k, i in enumerate(ids)]) > 0.97
    assert all(got[i] == (0, i, True) for i in range(2000, 2005)) and got[None] == (0, None, True)


# op8


def test_near_duplicates_equal_brute_force(docs, texts):
    ids = sorted(texts)
    value, bounds = minhash.items([texts[i] for i in ids])
    own = {i: value[a:b] for i, a, b in zip(ids, bounds[:-1], bounds[1:])}
    places, parent = {}, {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ids:
        for other in {o for x in set(own[i].tolist()) for o in places.setdefault(x, [])}:
            if minhash.similar(own[i], own[other]):
                a, b = find(i), find(other)
                parent[max(a, b)] = min(a, b)
        for x in set(own[i].tolist()):
            places[x].append(i)
    by_text = {}
    for i in ids:
        a, b = find(i), find(by_text.setdefault(texts[i], i))
        parent[max(a, b)] = min(a, b)
    rows = minhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in rows} == {i: find(i) for i in ids}
    assert all(r.kept == (r.doc_id == r.class_id) for r in rows)


def test_alignment():
    draw = np.random.default_rng(3)
    for _ in range(40):
        a = draw.integers(0, 30, draw.integers(1, 60)).astype(np.uint32)
        b = np.delete(a, draw.integers(0, len(a))) if draw.random() < 0.5 else np.insert(a, draw.integers(0, len(a)), draw.integers(0, 30, 2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
        m = best[-1, -1]
        assert minhash.similar(a, b) == (m >= 0.8 * (len(a) + len(b) - m) - 1e-9)


def test_star_of_edited_copies_is_one_class(spark):
    draw = np.random.default_rng(8)
    centre = [f"w{i}" for i in draw.integers(0, 10**6, 204)]
    texts = [" ".join(centre)]
    for i in range(1000):
        own = list(centre)
        for k in draw.choice(39, 4, replace=False):
            own[5 * k + 5] = f"e{i}x{k}"
        texts.append(" ".join(own))
    value, bounds = minhash.items(texts)
    own = [value[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    assert all(minhash.similar(own[0], x) for x in own[1:]) and not minhash.similar(own[1], own[2])
    order = draw.permutation(len(texts)).tolist()
    rows = minhash.near_duplicates(spark.createDataFrame([(i, texts[k]) for i, k in enumerate(order)], "doc_id long, text string").repartition(8), block=100).collect()
    assert {r.class_id for r in rows} == {0} and sum(r.kept for r in rows) == 1


def test_bitmaps_rule_no_link_out():
    draw = np.random.default_rng(9)
    own = []
    for _ in range(60):
        a = draw.integers(0, draw.choice([5, 10**6]), draw.integers(1, 300)).astype(np.uint32)
        own += [a, np.delete(a, draw.integers(0, len(a), len(a) // 8)), np.insert(a, draw.integers(0, len(a), len(a) // 6), 7)]
    a, b, _ = minhash.possible(np.array([len(x) for x in own]), [minhash.bitmap(x) for x in own], np.arange(len(own)), np.full(len(own), 2))
    held = {(min(x), max(x)) for x in zip(a.tolist(), b.tolist())}
    links = {(i, k) for i in range(len(own)) for k in range(i + 1, len(own)) if minhash.similar(own[i], own[k])}
    assert links <= held


def test_dedup_edge_cases(spark):
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, "a b"), (6, "a  b"), (None, "a b"), (None, None), (None, "zz top"), (8, "q w e r t y u i o p"), (9, "q w e r t y u i o"), (10, "these rows repeat here"), (10, "these rows repeat here")]
    source = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, u int")
    kept = sorted((r.doc_id or 0, r.text or "") for r in minhash.drop_near_duplicates(source).collect())
    assert kept == sorted([(1, ""), (2, ""), (3, ""), (5, "a b"), (0, ""), (0, "zz top"), (8, rows[9][1]), (10, rows[11][1])])
    assert minhash.near_duplicates(source.limit(0)).count() == 0


# op9


def test_permutation_and_its_inverse():
    for size in (1, 2, 3, 10, 1000):
        own = pii.Feistel(b"key")
        assert sorted(own("x", size, i) for i in range(size)) == list(range(size))
        assert all(own("x", size, own("x", size, i), back=True) == i for i in range(size))


def test_pseudonyms_keep_formats_and_can_be_undone(docs, texts):
    rows = pii.pseudonymise(docs, b"key").collect()
    back = pii.Pseudonyms(b"key", back=True)
    assert all(back(r.text)[0] == texts[r.doc_id] for r in rows) and sum(r.n_card + r.n_email + r.n_ip + r.n_phone for r in rows) > 0
    hide = pii.Pseudonyms(b"key")
    card = hide("4222038530831035 4222-0385-3083-1035")[0].split()
    assert card[0] == card[1].replace("-", "") != "4222038530831035" and pii.luhn_digit(card[0][:-1]) == card[0][-1]
    assert re.fullmatch(r"\d{4}-\d\d-\d\d", hide("2001-02-28")[0]) and hide("2001-02-30 1234567890123456 1.2.3.400")[1] == []


def test_pii_edge_cases(odd):
    assert pii.mask(odd, b"k").columns == odd.columns and pii.mask(odd, b"k").count() == odd.count()
    assert pii.pseudonymise(odd.limit(0), b"k").count() == 0


# pipeline


def test_pipeline(spark, sf_dir, docs, texts):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "quality_rules", "near_duplicates", "secret_scans", "packing"]
    labels = {r.doc_id for r in quality.judge_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).filter("kept").collect()}
    assert {r.doc_id for r in stages["quality_rules"](spark, docs, sf_dir).collect()} == labels
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} <= set(texts) and len({r.doc_id for r in rows}) > 0.7 * len(texts)
