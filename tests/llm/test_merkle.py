from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest

from pyspark.sql import functions as F

from salesloom.llm import common, merkle
from salesloom.llm.queries import ORACLES, QUERIES
from tests.conftest import DATA, values


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes, place, replaced, fanout):
    """Root of a list of digests, the siblings on the way up, and the root with another digest in the place."""
    siblings = []
    while len(nodes) > 1:
        begin = place - place % fanout
        own = nodes[begin : begin + fanout]
        siblings += own[: place - begin] + own[place - begin + 1 :]
        replaced = digest(*own[: place - begin], replaced, *own[place - begin + 1 :])
        nodes = [digest(*nodes[k : k + fanout]) for k in range(0, len(nodes), fanout)]
        place //= fanout
    return nodes[0], siblings, replaced


def plain(rows, fanout=2):
    """rows: (id, group, leaf, changed); the manifest by its definition."""
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, r[2], r[3] or "")):
        groups.setdefault(row[1], []).append(row)
    subroots = [climb([r[2] for r in members], 0, "", fanout)[0] for members in groups.values()]
    found = []
    for g, members in enumerate(groups.values()):
        leaves = [r[2] for r in members]
        for k, (row_id, _, leaf, changed) in enumerate(members):
            subroot, low, folded = climb(leaves, k, changed or leaf, fanout)
            root, high, folded = climb(subroots, g, folded, fanout)
            found.append((row_id, leaf, subroot, root, digest(*low, *high), folded, folded == root))
    return sorted(found, key=str)


def manifest(frame, **shape):
    return merkle.manifest(frame, F.col("g"), F.col("i"), F.col("leaf"), F.col("changed"), merkle.Shape(**shape))


@pytest.mark.parametrize("shape", [{"fanout": 2, "block": 4}, {"fanout": 2, "block": 64}, {"fanout": 3, "block": 9}])
def test_manifest_equals_plain_python(spark, shape):
    common.prepared(spark)
    rows = []
    for g, n in (("en", 150), ("", 1), (None, 5), ("é", 64), ("z", 65), ("de", 2), ("fr", 9)):
        rows += [(i * 3 % n, g, digest(f"{g}-{i}"), digest("other", str(i)) if i % 7 == 0 else None) for i in range(n)]
    rows += [(4, "fr", digest("fr-x"), None), (4, "fr", digest("fr-x"), None), (None, "en", digest("no id"), None)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "i bigint, g string, leaf string, changed string, root string")
    found = manifest(frame, **shape)
    assert found.columns == ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows, shape["fanout"])


def test_single_leaf_and_empty_table(spark):
    common.prepared(spark)
    frame = spark.createDataFrame([(1, None, digest("a"), None)], "i bigint, g string, leaf string, changed string")
    assert [tuple(r) for r in manifest(frame).collect()] == [(1, digest("a"), digest("a"), digest("a"), digest(), digest("a"), True)]
    assert manifest(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        merkle.Shape(2, 63)


def test_folding_resumes_states():
    children = [digest(str(k)) for k in range(5)]
    parent = merkle.Parent(children)
    for slot in range(5):
        assert parent.folded(slot, children[slot]) == parent.digest
        changed = [*children[:slot], digest("new"), *children[slot + 1 :]]
        assert parent.folded(slot, digest("new")) == digest(*changed)


def test_query_equals_its_sql_and_plain_python(spark, folder):
    long = "ß€ word " * 20_000
    rows = [(k, None if k % 5 == 0 else f"text {k}", [None, "en", "de", "fr"][k % 4], "s" if k % 3 else None, k if k % 6 else None) for k in range(90)]
    rows += [(500, long, "en", "s", 2**31 - 1), (500, long, "en", "s", 2**31 - 1), (501, "", "en", "", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")

    def leaf(row, more=0):
        fields = (row[0], row[3], row[2], None if row[4] is None else row[4] + more, row[1])
        return digest(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))

    want = plain([(r[0], r[2], leaf(r), leaf(r, 1) if zlib.crc32(str(r[0]).encode()) % 7 == 0 else None) for r in rows])
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in QUERIES["op11_merkle_manifest"](spark, folder).select(columns).collect()), key=str) == want
    for path in (f"{folder}/documents.parquet/*.parquet", f"{DATA}/documents.parquet"):
        with duckdb.connect() as session:
            session.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}')")
            by_sql = session.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES['op11_merkle_manifest']})").fetchall()
        if path.startswith(folder):
            assert sorted(by_sql, key=str) == want
        else:
            mine = values(QUERIES["op11_merkle_manifest"](spark, DATA), *columns)
            assert sorted(map(str, by_sql)) == sorted(str(tuple(r)) for r in mine)
