"""Merkle manifest, byte-level BPE and embedding whitening."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_SMALL
from llm_fixtures import DOCS, edge_rows, make_docs  # noqa: F401
from llm_words import words
from pyspark.sql import functions as F

from branchcost.llm import bpe, merkle, queries, whitening
from branchcost.llm.common import table

LOWER = {c: c + 32 for c in range(65, 91)}


# ---- Merkle manifest


def _hash(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(r, text):
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return _hash(["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _levels(leaves, fanout):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([_hash(out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def _runs(levels, i, fanout):
    for level in levels[:-1]:
        run = level[i - i % fanout :][:fanout]
        yield run[: i % fanout], run[i % fanout + 1 :]
        i //= fanout


def _manifest(rows, fanout=16):
    """(doc_id, leaf, subroot, root, proof hash, folded root, verified) by plain recursion."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        by_source[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r, r["text"])))
        trees.append(_levels([_leaf(r, r["text"]) for r in by_source[s]], fanout))
    top = _levels([t[-1][0] for t in trees], fanout)
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by_source[s]):
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                text = text.translate(LOWER)
            runs = [*_runs(trees[k], i, fanout), *_runs(top, k, fanout)]
            node = _leaf(r, text)
            for a, b in runs:
                node = _hash([*a, node, *b])
            root = top[-1][0]
            proof = _hash([x for a, b in runs for x in a + b])
            out.append((r["doc_id"], _leaf(r, r["text"]), trees[k][-1][0], root, proof, node, node == root))
    return out


def _sorted(rows):
    return sorted(tuple(r) for r in rows) if all(r[0] is not None for r in rows) else sorted(map(repr, map(tuple, rows)))


def _query(df, tmp_path):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return queries.op12_merkle(df.sparkSession, str(tmp_path)).collect()


def test_manifest_against_plain_recursion(spark, make_docs, edge_rows, tmp_path):
    rows = list(edge_rows) + [(100 + i, f"Text {i}", "long") for i in range(300)] + [(900, "Alone", "single")]
    docs = make_docs(rows, clash=True)
    want = _manifest([r.asDict() for r in docs.collect()])
    got = _query(docs, tmp_path)
    assert _sorted(got) == _sorted(want)
    assert {r["verified"] for r in got} == {True, False}


@pytest.mark.parametrize("fanout, levels", [(2, 1), (3, 1), (2, 2)])
def test_rounds_of_the_butterfly(make_docs, fanout, levels):
    docs = make_docs([(i, f"text {i}", "abcde"[i % 5] if i % 3 else "a") for i in range(150)])
    found = merkle.document_manifest(docs, None, fanout, levels)
    root = merkle.folded(F.col("shown"), F.col("proof"), F.col("path"))
    got = found.select("doc_id", "leaf", "subroot", "root", merkle.digest(F.col("proof")), root.alias("folded")).collect()
    want = [(*w[:5], w[3]) for w in _manifest([r.asDict() for r in docs.collect()], fanout)]
    assert _sorted(got) == _sorted(want)


def test_trees_around_the_size_of_a_block(make_docs):
    sizes = [1, 2, 3, 4, 8, 9, 10, 16, 17, 27, 28, 55]
    rows = [(100 * n + i, f"text {n} {i}", f"s{n}") for n in sizes for i in range(n)]
    docs = make_docs(rows)
    for fanout, levels in ((2, 3), (3, 2), (3, 3)):
        found = merkle.document_manifest(docs, None, fanout, levels)
        root = merkle.folded(F.col("shown"), F.col("proof"), F.col("path"))
        got = found.select("doc_id", "leaf", "subroot", "root", merkle.digest(F.col("proof")), root.alias("folded")).collect()
        want = [(*w[:5], w[3]) for w in _manifest([r.asDict() for r in docs.collect()], fanout)]
        assert _sorted(got) == _sorted(want)


def test_no_blocks_of_proofs_in_python(make_docs, monkeypatch):
    plans, stage = [], merkle.stage_table

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(merkle, "stage_table", lambda df, name: stage(planned(df), name))
    docs = make_docs([(i, f"text {i}", "ab"[i % 2]) for i in range(20)])
    last = planned(merkle.document_manifest(docs))
    # a batch for a Python worker has thousands of rows, and a block's proofs are 20 MB
    assert len(plans) > 5 and not [p for p in plans if "Python" in p or "Pandas" in p]
    # block to runs to leaves: no row holds more than a run's proofs
    assert last.count() == 20 and plans[-1].count("Generate ") >= 2 and "posexplode" in plans[-1]


def test_manifest_of_one_row_and_of_none(spark, make_docs, tmp_path):
    one = _query(make_docs([(7, None, None)]), tmp_path / "one")
    assert one[0]["leaf"] == one[0]["subroot"] == one[0]["root"] == one[0]["folded_root"] and one[0]["verified"]
    assert one[0]["proof_sha256"] == hashlib.sha256(b"").hexdigest()
    assert _query(spark.createDataFrame([], DOCS), tmp_path / "none") == []


# ---- byte-level BPE


PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(PATH))


ODD = ["'", "s", "t", "re", "ve", "r", "v", "l", "ll", "m", "d", "e", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\u200b", "\x1c",
       "\0", "1", "\u0663", "\u2167", "x", "É", "日", "😀", "!", "-", "\u0308", "'S", "<|endoftext|>"]


def _ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_ids_are_those_of_the_library(codec, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(40))) for _ in range(4000)]
    texts += [words(5, 400, 10_000), "", "a" * 5000 + "bc" * 3000, " " * 3000 + "x", "\n" * 70, "é" * 40, "x" * 16 + " " + "x" * 17]
    assert [_ids(x) for x in codec.encode(texts)] == [library.encode_ordinary(t) for t in texts]
    for t, ids in zip(texts, codec.encode(texts)):
        starts = codec.starts(ids)
        assert codec.decode(ids) == t.encode()
        k, n = len(starts) // 3, len(starts)
        at, part = bpe.decode_range(codec, ids, starts.astype("<u4").tobytes(), k, n - k)
        assert t.encode()[at : at + len(part)] == part and at == (starts[k] if n else 0)


def test_scan_of_transitions_is_the_walk(monkeypatch):
    rng = np.random.default_rng(2)
    kinds = rng.integers(0, 11, 3000).astype(np.uint8)
    state, want = bpe.NONE, []
    for k in kinds:
        state = int(bpe.transitions()[k, state])
        want.append(state)
    for row in (1, 7, 64, 4096):
        monkeypatch.setattr(bpe, "ROW", row)
        assert bpe.states_after(kinds).tolist() == want


def test_cache_and_groups_do_not_change_ids(codec, library, monkeypatch):
    texts = [words(50 + i, 80, 3000) for i in range(30)]
    monkeypatch.setattr(bpe, "CACHED_PIECES", 5)
    got = [_ids(x) for g in bpe._groups(texts, 700) for x in codec.encode(g)]
    assert got == [library.encode_ordinary(t) for t in texts]


def test_pieces_of_one_hash_stay_apart():
    data = b"abcabcabdabc" + b"long piece of bytes" * 2
    cuts = np.array([0, 3, 6, 9, 12, 31])
    number, distinct = bpe.distinct_pieces(data, cuts)
    assert [distinct[i] for i in number] == [b"abc", b"abc", b"abd", b"abc"] + [b"long piece of bytes"] * 2


def test_query_of_ids(spark, make_docs, edge_rows, library, tmp_path):
    make_docs(edge_rows, clash=True).write.parquet(str(tmp_path / "documents.parquet"))
    for folder, rows in ((str(tmp_path), edge_rows), (SF_SMALL, None)):
        rows = rows or [(r["doc_id"], r["text"], None) for r in table(spark, folder, "documents").collect()]
        want = []
        for i, t, _ in rows:
            ids = library.encode_ordinary(t or "")
            packed = np.array(ids, "<u4").tobytes()
            want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
        assert _sorted(queries.op13_bpe(spark, folder).collect()) == _sorted(want)
    assert queries.op13_bpe(spark, folder).schema == bpe_schema(spark, tmp_path / "none")


def test_documents_keep_their_columns_and_decode(make_docs, edge_rows, monkeypatch):
    monkeypatch.setattr(bpe, "SCAN", 300)
    docs = make_docs(edge_rows, clash=True)
    found = bpe.decode_documents(bpe.encode_documents(docs, PATH, "tokens").withColumn("ids", F.col("tokens.ids")), PATH, "ids", "bytes")
    rows = found.collect()
    assert found.columns == [*docs.columns, "tokens", "ids", "bytes"] and len(rows) == len(edge_rows)
    assert all(bytes(r["bytes"]) == (r["text"] or "").encode() for r in rows)
    none = found.withColumn("ids", F.lit(None).cast("binary")).drop("bytes")
    assert {r["bytes"] for r in bpe.decode_documents(none, PATH, "ids", "bytes").collect()} == {None}


def bpe_schema(spark, path):
    spark.createDataFrame([], DOCS).write.parquet(str(path / "documents.parquet"))
    found = queries.op13_bpe(spark, str(path))
    assert found.collect() == []
    return found.schema


# ---- embedding whitening


def _symmetric(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    a = (q * np.array(values, float)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1, 49) ** 2.0,
        [1] * 10 + list(range(2, 20)),
        [*(1 + 1e-9 * np.arange(15)), *range(2, 20)],
        [*(1 + 1e-12 * np.arange(5)), *(3 + 1e-7 * np.arange(8)), *range(5, 30)],
        10.0 ** np.linspace(-12, 6, 30),
        [0] * 10 + list(range(1, 10)),
        [5.0],
        [2.0] * 6,
        [0.0] * 4,
    ],
)
def test_refined_eigenvectors(values):
    a = _symmetric(values).astype(np.longdouble)
    got, x = whitening.refined_eigenvectors(a)
    scale = max(1e-300, float(np.abs(a).max()))
    assert np.abs(a @ x - x * got).max() <= 1e-14 * scale
    assert np.abs(x.T @ x - np.eye(len(a))).max() <= 1e-18
    assert np.abs(np.sort(np.array(values, float)) - got).max() <= 1e-14 * max(1.0, np.abs(values).max())


def _whitened(vectors):
    x = np.floor(1024 * np.clip(np.array(vectors, float), -whitening.LARGEST, whitening.LARGEST)).astype(np.int64).astype(object) + 100_000
    n, s = len(x), x.sum(0)
    y = np.array(x * n - s, object)
    cov = (y.T @ y / n**3).astype(float)
    e, v = np.linalg.eigh(cov)
    k = min(8, len(e))
    e, v = e[::-1], v[:, ::-1][:, :k]
    off = (y / n).astype(float)
    return [sum(int(d) ** 2 for d in row) for row in y], off @ v / np.sqrt(e[:k]), e[:k] / e.sum(), n


def _compare(found, ids, vectors):
    deviation, w, share, n = _whitened(vectors)
    got = {(r["vec_id"], r["component"]): r for r in found}
    assert len(got) == len(found) == w.size
    for c in range(w.shape[1]):
        column = np.array([got[i, c + 1]["whitened"] for i in ids])
        assert min(np.abs(column - w[:, c]).max(), np.abs(column + w[:, c]).max()) < 1e-9
    for k, i in enumerate(ids):
        r = got[i, 1]
        assert r["deviation"] == deviation[k] and r["n"] == n and r["identity_error"] < 1e-9
        assert abs(r["explained"] - share[0]) < 1e-12


VECTORS = "vec_id bigint, embedding array<float>, label int, n int, w string, component string"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", "y") for i, v in rows], VECTORS)


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((300, 12)) @ rng.standard_normal((12, 12))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(900, None), (901, [1.0] * 11 + [None]), (902, [1.0] * 11 + [float("nan")]), (903, [float("inf")] * 12), (904, [])]
    df = _table(spark, rows + bad).repartition(5)
    _compare(whitening.whiten(df).collect(), range(300), vectors)
    # by length: three entries give three components
    short = rng.standard_normal((40, 3)).astype(np.float32)
    both = whitening.whiten(_table(spark, rows + [(1000 + i, v.tolist()) for i, v in enumerate(short)])).collect()
    _compare([r for r in both if r["vec_id"] < 1000], range(300), vectors)
    _compare([r for r in both if r["vec_id"] >= 1000], range(1000, 1040), short)


def test_sums_are_exact_for_any_dealing_and_size(spark):
    rng = np.random.default_rng(5)
    large = rng.standard_normal((60, 4)).astype(np.float32) * np.float32(2**33)
    rows = [(i, v.tolist()) for i, v in enumerate(large)]
    found = whitening.whiten(_table(spark, rows)).collect()
    deviation, _, _, _ = _whitened(large)
    assert {r["vec_id"]: int(r["deviation"]) for r in found} == dict(enumerate(deviation))
    usable = whitening.usable(_table(spark, rows), "vec_id", "embedding")
    one, many = whitening.fit(usable.coalesce(1), 4), whitening.fit(usable.repartition(7), 4)
    assert np.array_equal(one.components, many.components) and np.array_equal(one.values, many.values)


def test_whitening_without_variance(spark):
    kinds = [r["whitened"] for r in whitening.whiten(_table(spark, [(1, [0.5, 2.0])])).collect()]
    assert kinds == [0.0, 0.0]
    same = whitening.whiten(_table(spark, [(None, [0.5, 2.0])] * 3)).collect()
    assert len(same) == 6 and {(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in same} == {(0.0, 0.0, 1.0, 0)}
    line = whitening.whiten(_table(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])).collect()
    assert {r["component"]: r["identity_error"] for r in line}[1] == pytest.approx(1.0)
    assert sum(r["whitened"] ** 2 for r in line if r["component"] == 1) == pytest.approx(5)
    none = whitening.whiten(_table(spark, [(1, None), (2, [])]))
    assert none.collect() == [] and none.columns == whitening.whiten(_table(spark, [(1, [1.0])])).columns


def test_query_of_whitening(spark):
    found = queries.op11_whitening(spark, SF_SMALL)
    assert dict(found.dtypes)["deviation"] == "bigint"
    rows = table(spark, SF_SMALL, "embeddings").collect()
    _compare(found.collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])
