import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import manifest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    shown = None if value is None else str(value)
    return "-" if shown is None else f"{len(shown.encode())}:{shown}"


def climb(nodes):
    """The root of a list of nodes, and the siblings of each by level."""
    proofs, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, at in enumerate(where):
            start = at // 16 * 16
            proofs[leaf].append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + 16])))
        where = [at // 16 for at in where]
        nodes = [H("".join(nodes[at : at + 16])) for at in range(0, len(nodes), 16)]
    return nodes[0], proofs


def brute(rows):
    sources = {}
    for row in rows:
        leaf = H("".join(field(row[c]) for c in manifest.FIELDS))
        changed = None
        if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0:
            texts = {**row.asDict(), "text": row["text"] and row["text"].translate(LOWER)}
            changed = H("".join(field(texts[c]) for c in manifest.FIELDS))
        sources.setdefault(row["source"], []).append((row["doc_id"], leaf, changed))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    found = []
    for source in order:
        leaves = sorted(sources[source], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        found.append((leaves, *climb([leaf for _, leaf, _ in leaves])))
    if not found:
        return []
    root, above = climb([subroot for _, subroot, _ in found])
    out = []
    for (leaves, subroot, proofs), top in zip(found, above):
        for (doc_id, leaf, changed), proof in zip(leaves, proofs):
            path = proof + top
            node = changed or leaf
            for left, right in path:
                node = H(left + node + right)
            sibling = H("".join(left + right for left, right in path))
            out.append((doc_id, leaf, subroot, root, sibling, node, node == root))
    return out


def result(docs, digits=manifest.DIGITS):
    rows = manifest.manifest(docs, digits)
    node = manifest.folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    shown = rows.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("proof")), node, node == F.col("root")
    )
    return sorted(map(tuple, shown.collect()), key=str)


def expected(docs):
    return sorted(brute(docs.collect()), key=str)


@pytest.mark.parametrize("digits", [1, 3])
def test_documents(documents, digits):
    """Blocks of 16 rows have blocks of blocks above them; the tree is the same."""
    got = result(documents, digits)
    assert got == expected(documents) and 0 < sum(row[-1] for row in got) < len(got)


def test_one_source_of_many_rows(documents):
    hot = documents.withColumn("source", F.lit("hot"))
    more = hot.union(hot.withColumn("doc_id", F.col("doc_id") + 1000)).union(documents.limit(17))
    assert result(more, 1) == expected(more)


def test_many_sources(documents):
    own = documents.withColumn("source", F.concat(F.lit("s"), F.col("doc_id").cast("string")))
    assert result(own, 1) == expected(own)


def test_odd_rows(odd_docs, no_docs):
    assert result(odd_docs) == expected(odd_docs)
    assert result(no_docs) == []


def test_repeated_rows(make_docs):
    """Equal rows are leaves of their own, and a missing id stands first."""
    docs = make_docs(["same text"] * 40).withColumn("doc_id", F.lit(7).cast("bigint"))
    docs = docs.union(make_docs([None, "A"]).withColumn("doc_id", F.lit(None).cast("bigint")))
    got = result(docs, 1)
    assert got == expected(docs) and len(got) == 42


def test_single_row(make_docs):
    (row,) = result(make_docs(["Only"]))
    assert row[1] == row[2] == row[3] and row[4] == H("")


@pytest.mark.parametrize("count", [16, 257])
def test_run_ends(make_docs, count):
    docs = make_docs([f"Text {at}" for at in range(count)])
    assert result(docs, 2) == expected(docs)


def test_other_columns_stay(documents):
    names = ("tree", "at", "node", "kids", "digit0", "height", "path", "key", "twin", "range", "size")
    odd = documents.withColumns({name: F.concat(F.lit("mine"), "doc_id") for name in names})
    leaves = manifest.tampered_leaves(odd).withColumns({n: F.lit(f"own {n}") for n in names})
    rows = manifest.proofs(leaves, "source", "doc_id")
    assert rows.columns == [*leaves.columns, "subroot", "root", "proof"]
    for row in rows.collect():
        assert all(row[n] == f"own {n}" for n in names)
    assert result(odd) == expected(documents)


def test_no_python_and_bounded_groups(documents):
    plan = manifest.manifest(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
