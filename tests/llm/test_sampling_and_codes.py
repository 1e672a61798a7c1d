"""Importance resampling, vector codes and piece encoding against brute force and the library."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as model_format

from liftlens.llm import codebooks, importance, pieces, queries
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, rank int, ids int, score int, __at int, n int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, equal rows, extra columns with clashing names."""
    body = " ".join(f"W{i % 97}-x{i % 13}é" for i in range(400))
    rows = [(1, body, "en"), (2, body, "en"), (2, body, "en"), (3, None, None), (4, "", "de"),
            (None, body[:300], None), (5, "  \n\t ", "de"), (6, "z" * 9000, "de"), (7, "a b c", "fr"),
            (8, "word " * 30_000, "fr"), (9, "▁a\0b 漢字 😀\u0004 ﬁn", "fr"), (None, None, None),
            (10, "A" + body + "-", "en")]
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], SCHEMA)


def key(row):
    return tuple((x is None, x) for x in row)


# importance resampling


def resampled_brute(docs, target, percent=5, min_words=20):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})

    def features(text):
        w = word.findall((text or "").translate(lower))
        return w, [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    parsed = [(d, *features(t)) for d, t in docs]
    s = Counter(bucket(f) for _, _, fs in parsed for f in fs)
    t = Counter(bucket(f) for text in target for f in features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000))))
    rows = []
    for d, w, fs in parsed:
        weight = sum(gain(bucket(f)) for f in fs)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([d, len(fs), weight, score, None, len(w)])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=key)


def test_resampling_equals_sql(spark):
    df = queries.QUERIES["op11_importance_sample"](spark, SF)
    assert difference(df, duck(SF), queries.ORACLE["op11_importance_sample"]) is None


@pytest.mark.parametrize("percent", [5, 60, 100])
def test_resampling_equals_brute_force(spark, odd, percent, monkeypatch):
    monkeypatch.setattr(importance.ranked, "__defaults__", (2,))  # several ranges
    target = odd.where("doc_id in (7, 9, 10)")
    got = sorted(map(tuple, importance.resample(odd, target, percent).collect()), key=key)
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert got == resampled_brute(docs, [t for d, t in docs if d in (7, 9, 10)], percent)


def test_resampling_of_empty_tables(spark, odd):
    none = odd.limit(0)
    assert importance.resample(none, odd).count() == 0
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = sorted(map(tuple, importance.resample(odd, none).collect()), key=key)
    assert got == resampled_brute(docs, [])


def test_sampled_keeps_columns(spark, odd):
    rows = importance.sampled(odd, odd.where("doc_id = 1"), 100)
    assert rows.columns == odd.columns
    # every text of at least 20 words, and the other row without a doc_id
    assert rows.count() == 7


def test_features_go_on_over_slices(spark):
    """Texts in one slice must not share features over their border."""
    import pyarrow as pa

    n, parts = importance.feature_buckets(pa.array(["a b", None, "", "c", "d e f"]))
    assert n.tolist() == [2, 0, 0, 1, 3]
    assert [len(r) for r, _ in parts] == [6, 3, 1]
    want = [zlib.crc32(f) % 10000 for f in (b"a b", b"d e", b"e f", b"d e f")]
    assert [*parts[1][1].tolist(), *parts[2][1].tolist()] == want


# vector codes


def lloyd_brute(rows, parts=8, entries=16, rounds=6):
    """rows: (vec_id, vector, label); vectors of one length that `parts` divides."""
    rows = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: ((r[0] is None, r[0] or 0), r[1]))
    steps = [[math.floor(4096 * x) for x in r[1]] for r in rows]
    d = len(steps[0]) // parts
    cut = [[s[p * d:(p + 1) * d] for p in range(parts)] for s in steps]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for c in cut:
                members[nearest(c[p], books[p])[1]].append(c[p])
            for i, m in members.items():
                books[p][i] = [sum(x) // len(m) for x in zip(*m)]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(f[0] for f in fs) for fs in found]
    by_label = Counter()
    for r, e in zip(rows, errors):
        by_label[r[2]] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((r[0], "".join(f"{f[1]:02x}" for f in fs), e, by_label[r[2]], sha)
                  for r, fs, e in zip(rows, found, errors))


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows],
                                 "vec_id long, embedding array<float>, label int, error int, codes int, ids int")


def test_codes_equal_sql(spark):
    df = queries.QUERIES["op12_vector_codes"](spark, SF)
    assert difference(df, duck(SF), queries.ORACLE["op12_vector_codes"]) is None


@pytest.mark.parametrize("kind", ["clusters", "grid", "few"])
def test_codes_equal_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(codebooks, "BLOCK", 100)
    monkeypatch.setattr(codebooks, "LEAF", 4)
    rng = np.random.default_rng(5)
    if kind == "clusters":  # most nodes are assigned whole
        centres = rng.normal(size=(20, 16)) * 10
        vectors = centres[rng.integers(20, size=400)] + rng.normal(size=(400, 16)) * 0.01
    elif kind == "grid":  # ties between entries, equal entries and equal vectors
        vectors = rng.integers(-2, 2, size=(300, 16)) / 4096
    else:
        vectors = rng.normal(size=(5, 16))
    vectors = vectors.astype(np.float32)
    rows = [(i * 3 % 1009, [float(x) for x in v], [None, 1, 2][i % 3]) for i, v in enumerate(vectors)]
    odd = [(2001, None, 1), (2002, [float("nan")] * 16, 1), (2003, [1.0] * 15 + [None], 1),
           (2004, [float("inf")] * 16, None), (2005, [], 1)]
    got = codebooks.codes(vector_frame(spark, rows + odd).repartition(3))
    assert sorted(map(tuple, got.collect())) == lloyd_brute(rows)


def test_whole_nodes_are_assigned_by_cached_sums():
    """On separate clusters nearly all members go with their node, and the sums are exact."""
    rng = np.random.default_rng(6)
    centres = rng.integers(-40000, 40000, size=(8, 16, 4))
    points = np.concatenate([centres[:, rng.integers(16, size=1000)] + rng.integers(-9, 9, size=(8, 1000, 4))], axis=1)
    tree = codebooks.build(points, 6)
    sums, counts = np.zeros((8, 16, 4), np.int64), np.zeros((8, 16), np.int64)
    found, share = codebooks.assign(tree, codebooks.codebook_tree(centres), sums, counts)
    assert share > 0.7
    distance = ((tree.points[:, :, None] - centres[:, None]) ** 2).sum(axis=3)
    assert (found == distance.argmin(axis=2)).all()
    for p in range(8):
        for e in range(16):
            assert (sums[p, e] == tree.points[p][found[p] == e].sum(axis=0)).all()
            assert counts[p, e] == (found[p] == e).sum()


def test_codes_of_odd_tables(spark):
    none = vector_frame(spark, [])
    assert codebooks.codes(none).count() == 0
    assert codebooks.codes(vector_frame(spark, [(1, None, 1), (None, [float("nan")], 1)])).count() == 0
    rows = [(None, [3.0, 1.0], None), (1, [3e38, -3e38], 7), (1, [3e38, -3e38], 7), (2, [1.0, 2.0, 3.0], 7)]
    got = codebooks.codes(vector_frame(spark, rows)).collect()
    # the vector of another length goes; components beyond the range count as its border
    assert sorted(((r["vec_id"], r["error"], r["label_error"]) for r in got), key=key) == [(1, 0, 0), (1, 0, 0), (None, 0, 0)]


# pieces

ALPHABET = [*"abcdefg  \n\t é▁ñ漢字😀\x00\x04Á½ﬁ À　 ́カ゛", "the ", "ing"]


def texts_of(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(30))) for _ in range(n)]


def check_codec(blob, texts):
    codec, library = pieces.Codec(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)
    for text, (ids, begins, ends) in zip(texts, codec.encode(texts)):
        assert ids.tolist() == library.encode(text, add_eos=True), text
        want = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(begins, ends))[:-1] == want, text
        assert codec.decode(ids.tolist()) == library.decode(ids.tolist()), text


def test_pieces_equal_the_library():
    check_codec(pieces.read_model(), texts_of(1, 1500))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("suffix", [True, False])
def test_compiled_maps_equal_the_library(rule, squeeze, suffix):
    made = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    spec = model_format.ModelProto.FromString(made).normalizer_spec
    assert len(spec.precompiled_charsmap) > 1000
    model = model_format.ModelProto.FromString(pieces.read_model())
    model.normalizer_spec.CopyFrom(spec)
    model.normalizer_spec.add_dummy_prefix = model.normalizer_spec.escape_whitespaces = True
    model.normalizer_spec.remove_extra_whitespaces = squeeze
    model.trainer_spec.treat_whitespace_as_suffix = suffix
    check_codec(model.SerializeToString(), texts_of(2, 400))


def test_decode_of_any_ids_equals_the_library():
    blob, rng = pieces.read_model(), random.Random(3)
    codec, library = pieces.Codec(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(260), 28705]) for _ in range(rng.randrange(12))]
        assert codec.decode(ids) == library.decode(ids)


def test_piece_query_equals_the_library(spark, odd):
    library = sentencepiece.SentencePieceProcessor(model_proto=pieces.read_model())

    def want(doc_id, text):
        ids = library.encode(text or "", add_eos=True)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))

    whole = spark.read.parquet(f"{SF}/documents.parquet")
    for docs, got in ((odd, pieces.digest(odd)), (whole, queries.QUERIES["op13_piece_ids"](spark, SF))):
        expected = sorted((want(r["doc_id"], r["text"]) for r in docs.collect()), key=key)
        assert sorted(map(tuple, got.collect()), key=key) == expected
    assert pieces.digest(odd.limit(0)).count() == 0


def test_spans_tile_the_text_and_decode_restores_it(spark, odd):
    rows = pieces.encode(odd)
    assert rows.columns == ["doc_id", "ids", "begins", "ends"]
    texts = {r["doc_id"]: r["text"] for r in odd.where("doc_id is not null").collect()}
    for r in rows.where("doc_id is not null").collect():
        raw = (texts[r["doc_id"]] or "").encode()
        assert b"".join(raw[b:e] for b, e in zip(r["begins"], r["ends"])) == raw
    back = {r["doc_id"]: r["decoded"] for r in pieces.decode(rows).collect()}
    assert all(back[d] == (t or "").replace("▁", " ") for d, t in texts.items())
