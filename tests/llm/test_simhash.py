import numpy as np
import pytest
import xxhash

from fieldloom.llm import simhash
from fieldloom.llm.components import components


def slow(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    fp = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return fp - (1 << 64) if fp >> 63 else fp


def classes(fps, first):
    """Smallest id reachable over links of at most four bits, by brute force."""
    x = np.array(fps, np.int64).view(np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 4
    label = np.array([float("inf") if i is None else i for i in first])
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return [None if v == float("inf") else int(v) for v in label]
        label = new


def test_fingerprints(docs, odd):
    for df in (docs.limit(60), odd):
        rows = df.collect()
        assert [simhash.fingerprint(r.text or "") for r in rows] == [slow(r.text) for r in rows]


def test_near_duplicates(docs, odd, none):
    for df in (docs, odd):
        rows = simhash.near_duplicates(df).collect()
        assert len(rows) == df.count()
        assert [r.component_id for r in rows] == classes([r.fp for r in rows], [r.doc_id for r in rows])
    assert simhash.near_duplicates(none).count() == 0


def test_deduplicate(docs, odd, none):
    rows = simhash.near_duplicates(docs).collect()
    assert sorted(r.doc_id for r in simhash.deduplicate(docs).collect()) == sorted(r.doc_id for r in rows if r.doc_id == r.component_id)
    assert simhash.deduplicate(odd).columns == odd.columns
    assert simhash.deduplicate(none).count() == 0


@pytest.fixture(scope="module")
def dense():
    """Thirty centres and the many fingerprints around each."""
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 64, 30, dtype=np.uint64)
    all_ = [base]
    for _ in range(25):
        x = base.copy()
        for _ in range(rng.integers(1, 4)):
            x = x ^ (np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64))
        all_.append(x)
    return np.unique(np.concatenate(all_))


def same_classes(fps, pairs, wanted):
    at = {int(f): i for i, f in enumerate(fps.view(np.int64))}
    label = list(range(len(fps)))
    for a, b in pairs:
        a, b = label[at[a]], label[at[b]]
        label = [min(a, b) if x in (a, b) else x for x in label]
    return len(set(zip(label, wanted, strict=True))) == len(set(label)) == len(set(wanted))


def test_group_links(dense):
    a, b = simhash.group_links(dense)
    assert len(a) < len(dense)
    assert same_classes(dense, zip(a.view(np.int64).tolist(), b.view(np.int64).tolist(), strict=True), classes(dense.view(np.int64), range(len(dense))))


def parted(fps, pairs):
    """Class of each fingerprint under the pairs (of numbers of fingerprints), by union-find."""
    up = list(range(len(fps)))

    def root(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return [root(x) for x in range(len(fps))]


@pytest.mark.parametrize("chains, length", [(1, 10), (60, 50), (1, 3000)])
def test_group_links_on_shuffled_chains(chains, length):
    """Chains whose members are four bits from the next one alone, in any order."""
    rng = np.random.default_rng(chains)
    steps = np.array([[np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, 4, replace=False).astype(np.uint64)) for _ in range(length)] for _ in range(chains)])
    fps = np.unique(np.bitwise_xor.accumulate(steps ^ np.where(np.arange(length) == 0, rng.integers(0, 1 << 64, (chains, 1), dtype=np.uint64), np.uint64(0)), axis=1))
    rng.shuffle(fps)
    near = [(k, int(m)) for k in range(len(fps)) for m in np.nonzero(np.bitwise_count(fps[k] ^ fps[k + 1 :]) <= 4)[0] + k + 1]
    at = {f: k for k, f in enumerate(fps.tolist())}
    a, b = simhash.group_links(fps)
    assert parted(fps, [(at[x], at[y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)]) == parted(fps, near)


@pytest.mark.parametrize("options", [{}, {"hot": 4}, {"blocks": 8, "hot": 3}])
def test_hot_groups_lose_no_link(spark, dense, options):
    df = spark.createDataFrame([(int(f),) for f in dense.view(np.int64)], "fp long")
    pairs = [(r.a, r.b) for r in simhash.links(df, **options).collect()]
    assert same_classes(dense, pairs, classes(dense.view(np.int64), range(len(dense))))


def test_tables_agree_on_all_but_four_blocks():
    assert [len(simhash.table_masks(b)) for b in simhash.LADDER[:3]] == [15, 35, 70]
    assert simhash.blocks_for(1000) == 6 and simhash.blocks_for(10**9) == 10 and simhash.blocks_for(10**15) == 16


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (200, 200)]
    out = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(1, 61)} | {101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
