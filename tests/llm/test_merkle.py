"""The Merkle manifest against a plain tree: sparse and repeated ids, null fields, groups of any size."""

import hashlib
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from seatracks.llm import merkle

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _g string, leaf string, root int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(d, t, lang, source, n):
    return h(*map(field, (d, source, lang, n, t)))


def tree(nodes):
    """The root and each node's runs upwards: (left, right)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for p, x in zip(paths, at, strict=True):
            run = x // 3 * 3
            p.append(("".join(level[run:x]), "".join(level[x + 1 : run + 3])))
        at = [x // 3 for x in at]
        level = [h(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return level[0], paths


def brute(data):
    groups = defaultdict(list)
    for d, t, lang, source, n, *_ in data:
        leaf = leaf_of(d, t, lang, source, n)
        bad = leaf if t is None or d is None or zlib.crc32(str(d).encode()) % 2 else leaf_of(d, t.replace("\n", ""), lang, source, n)
        groups[(b"" if source is None else b"=" + source.encode())].append(((d is not None, d or 0, leaf), leaf, bad, d))
    subs, rows = [], []
    for i, g in enumerate(sorted(groups)):
        members = sorted(groups[g])
        sub, paths = tree([m[1] for m in members])
        subs.append(sub)
        rows += [(i, m, p) for m, p in zip(members, paths, strict=True)]
    root, above = tree(subs)
    out = []
    for i, (_, leaf, bad, d), p in rows:
        path, x = p + above[i], bad
        for lo, hi in path:
            x = h(lo, x, hi)
        out.append((repr(d), leaf, subs[i], root, h(*[s for pair in path for s in pair]), x, x == root))
    return sorted(out)


def got(df):
    return sorted((repr(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect())


def row(d, t, source, n=None, lang="en"):
    return (d, t, lang, source, n, "x", "y", 1)


def test_groups_of_all_sizes(spark):
    sizes = [1, 2, 3, 4, 9, 10, 27, 81, 82, 83, 250]
    ids = iter([i * 7 % 3001 for i in range(3001)])
    data = [row(next(ids), f"text\n{i}", f"s{k}é", i) for k, n in enumerate(sizes) for i in range(n)]
    assert got(merkle.tampering_found(spark.createDataFrame(data, COLUMNS))) == brute(data)


def test_sparse_negative_null_and_repeated_ids(spark):
    ids = [-(1 << 62), -65, -64, -1, 0, 1, 62, 63, 64, 127, 1 << 40, (1 << 62) + 5, 4096, 65536]
    data = [row(i, f"a\nb {i}", "s", 3) for i in ids]
    data += [row(63, "another text\n", "s", 3), row(63, "a third", "s", None), row(63, "a third", "s", None), row(64, None, "s", None, None)]
    data += [row(None, f"no id\n{i}", "s") for i in range(5)] + [row(None, "no id\n1", "s"), row(None, None, None, None, None), row(5, "", None), row(6, "\n\n", "")]
    data += [row(7, "long\n" * 300_000, "other")]
    assert got(merkle.tampering_found(spark.createDataFrame(data, COLUMNS))) == brute(data)


def test_one_row_one_group_and_none(spark):
    for data in ([row(4, "a\n", "s")], [row(4, "a\n", "s"), row(9, "b", "s")], [row(4, "a\n", "s"), row(9, "b", "t"), row(8, "b", None)]):
        assert got(merkle.tampering_found(spark.createDataFrame(data, COLUMNS))) == brute(data)
    assert merkle.tampering_found(spark.createDataFrame([], COLUMNS)).count() == 0


def test_words_keep_only_what_has_bits(spark):
    leaves = spark.range(0, 1 << 40, 1 << 33).select(F.lit("=a").alias("_g"), F.lit(False).alias("_z"), F.col("id").alias("_k"))
    words = merkle.ranked(merkle.bitmaps(leaves)).collect()
    assert [(r.base, r._m) for r in sorted(words, key=lambda r: r._w)] == [(i, 128) for i in range(128)]
