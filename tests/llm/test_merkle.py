"""The Merkle manifest against a plain tree, for several stored heights."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tagwise.llm import merkle

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
leaf_of = lambda r: sha("".join(map(field, r)))


def levels_of(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + arity])) for i in range(0, len(out[-1]), arity)])
    return out


def walk(levels, i, digest, arity):
    met = ""
    for level in levels[:-1]:
        begin = i - i % arity
        run = level[begin:begin + arity]
        met += "".join(run[:i - begin] + run[i - begin + 1:])
        run[i - begin] = digest
        digest, i = sha("".join(run)), i // arity
    return digest, met


def plain(records, changed, arity):
    """(key, leaf, subroot, root, proof, folded) of every record."""
    groups = {}
    for r in records:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        rs = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((rs, levels_of([leaf_of(r) for r in rs], arity)))
    top = levels_of([t[-1][0] for _, t in trees], arity)
    for k, (rs, tree) in enumerate(trees):
        for i, r in enumerate(rs):
            digest, low = walk(tree, i, leaf_of(changed(r)), arity)
            digest, high = walk(top, k, digest, arity)
            yield r[0], tree[0][i], tree[-1][0], top[-1][0], low + high, digest


def got(df, claim, **kw):
    return sorted((r["key"], r["leaf"], r["subroot"], r["root"], bytes(r["proof"]).hex(), r["folded_root"], r["verified"])
                  if r["key"] is not None else (-10**9, r["leaf"], r["subroot"], r["root"], bytes(r["proof"]).hex(), r["folded_root"], r["verified"])
                  for r in merkle.verify(merkle.manifest(df, claim, **kw)).collect())


def want(records, changed, arity):
    return sorted((-10**9 if k is None else k, a, s, root, p, f, f == root) for k, a, s, root, p, f in plain(records, changed, arity))


@pytest.mark.parametrize("arity,levels", [(3, 1), (3, 2), (2, 3)])
def test_equals_a_plain_tree(spark, docs, rows, arity, levels):
    records = [(r[0], r[3], r[2], r[4], r[1]) for r in rows]
    odd = F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False))
    claim = {"text": F.when(odd, F.replace("text", F.lit("a"), F.lit(""))).otherwise(F.col("text"))}
    change = lambda r: (*r[:4], r[4].replace("a", "") if r[4] is not None and r[0] is not None and r[0] % 2 == 1 else r[4])
    mine = got(docs, claim, arity=arity, levels=levels)
    assert mine == want(records, change, arity)
    assert {v[-1] for v in mine} == {True, False}


def test_deep_tree_of_one_group(spark):
    """A hot group over several stored rows, run lengths of every rest."""
    for n in (2, 10, 28):
        recs = [(i * 7 % n + 1000, "hot", "en", i, f"text {i}") for i in range(n)]
        df = spark.createDataFrame(recs, "doc_id long, source string, lang string, n_chars long, text string")
        assert got(df, None, levels=2) == want(recs, lambda r: r, 3)


def test_a_lone_record_is_the_root(spark):
    df = spark.createDataFrame([(1, None, None, None, None, "x")], "doc_id long, source string, lang string, n_chars long, text string, leaf string")
    r = merkle.verify(merkle.manifest(df)).collect()
    assert len(r) == 1 and r[0]["leaf"] == r[0]["subroot"] == r[0]["root"] == sha("1:1" + "-" * 4) and r[0]["verified"] and bytes(r[0]["proof"]) == b""


def test_empty_table_and_clashing_names(spark, empty):
    assert merkle.verify(merkle.manifest(empty)).collect() == []
    df = spark.createDataFrame([(i, "s", "en", 1, f"t{i}", 9, "p") for i in range(5)],
                               "doc_id long, source string, lang string, n_chars long, text string, place long, tree string")
    assert got(df, None) == got(df.drop("place", "tree"), None)


def test_altered_order_of_input_gives_the_same_root(docs):
    assert merkle.manifest(docs).root == merkle.manifest(docs.repartition(5)).root
    assert merkle.manifest(docs).root != merkle.manifest(docs.where("doc_id <> 303 or doc_id is null")).root


def test_recursion_limit_is_given_back(spark, docs):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.climb(merkle.manifest(docs))
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
