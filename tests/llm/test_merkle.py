import random
import zlib

from pyspark.sql import functions as F

from hooklens.llm import merkle
from tests.llm.helpers import HARD, documents, lower, sha


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Root of nodes and each one's (left, right) siblings on the way."""
    paths, own, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, at in enumerate(own):
            run = at // 16 * 16
            paths[i].append(("".join(level[run:at]), "".join(level[at + 1 : run + 16])))
        level = [sha("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
        own = [at // 16 for at in own]
    return level[0], paths


def plain(rows):
    full = [(i, s, lang, None if t is None else len(t), t) for i, t, lang, s in rows]
    groups = {}
    for r in full:
        groups.setdefault((r[1] is not None, (r[1] or "").encode()), []).append(r)
    roots, found = [], []
    for key in sorted(groups):
        mine = sorted(groups[key], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        root, paths = climb([leaf(r) for r in mine])
        found.append((mine, root, paths))
        roots.append(root)
    out = []
    if roots:
        root, tops = climb(roots)
        for (mine, subroot, paths), top in zip(found, tops):
            for r, path in zip(mine, paths):
                way = path + top
                folded = leaf(r)
                if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                    folded = leaf((*r[:4], lower(r[4])))
                for a, b in way:
                    folded = sha(a + folded + b)
                out.append((r[0], leaf(r), subroot, root, sha("".join(a + b for a, b in way)), folded, folded == root))
    return sorted(out, key=str)


def found(spark, rows):
    docs = documents(spark, rows).withColumns({"key": F.lit("clash"), "slot": F.lit(1), "digest": F.lit("x"), "_n": F.lit(2)})
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.build(docs, merkle.lower_ascii(F.col("text")), touched).collect()
    return sorted((tuple(r) for r in got), key=str)


def test_hard_rows_and_empty_table(spark):
    assert found(spark, HARD) == plain(HARD)
    assert found(spark, []) == []
    assert found(spark, HARD[:1]) == plain(HARD[:1])


def test_levels_ids_and_repeats(spark):
    """Sources of one to 300 rows, more than sixteen of them; sparse, negative, repeated and missing ids."""
    rng = random.Random(5)
    text = lambda: " ".join(rng.choices(["Ab", "cd", "EF"], k=3))
    rows = [(i, text(), "en", "dense") for i in rng.sample(range(300), 273)]
    rows += [(rng.randrange(-(2**63), 2**63), text(), "fr", "sparse") for _ in range(40)]
    rows += [(x, text(), None, "ends") for x in (-(2**63), 2**63 - 1, -1, 0, 1, 63, 64, 127, 128, -64, -65, 2**20, 2**34, 2**48)]
    rows += [(7, text(), "en", "one id") for _ in range(50)] + [(None, text(), "en", "no id") for _ in range(50)]
    rows += [(None, "Equal", "en", None)] * 20 + [(3, "Equal", "en", None)] * 20
    rows += [(i, text(), "en", f"s{i}é") for i in range(20)]
    rng.shuffle(rows)
    assert found(spark, rows) == plain(rows)
