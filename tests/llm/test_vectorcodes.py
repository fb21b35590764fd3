import hashlib
import math
import random
import struct

from loomsift.llm import vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int, v string, code string"


def f32(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def brute(rows, parts=4, entries=256, rounds=4):
    """Plain loops over Python integers."""
    kept = [(i, e, lab) for i, e, lab in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    small = [(i, [math.floor(1024 * f32(x)) for x in e], lab) for i, e, lab in kept if all(abs(x) < 32768 for x in e)]
    small.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(small[0][1]) if small else -1
    good = [r for r in small if len(r[1]) == size]
    width = -(-size // parts)
    cut = lambda v: [(v + [0] * (parts * width - size))[p * width : (p + 1) * width] for p in range(parts)]
    vectors = [(i, cut(v), lab) for i, v, lab in good]
    books = [[v[p] for _, v, _ in vectors[:entries]] for p in range(parts)]

    def near(part, book):
        found = [sum((a - b) ** 2 for a, b in zip(part, c)) for c in book]
        return found.index(min(found)), min(found)

    for _ in range(rounds):
        for p in range(parts):
            met = {}
            for _, v, _ in vectors:
                met.setdefault(near(v[p], books[p])[0], []).append(v[p])
            for e, group in met.items():
                books[p][e] = [sum(xs) // len(group) for xs in zip(*group)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out = []
    for i, v, lab in vectors:
        found = [near(v[p], books[p]) for p in range(parts)]
        out.append([i, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), lab])
    out += [[i, None, None, lab] for i, e, lab in kept if len(e) != size or any(abs(x) >= 32768 for x in e)]
    total = {}
    for _, _, d, lab in out:
        if d is not None:
            total[lab] = total.get(lab, 0) + d
    return sorted(((i, c, d, total.get(lab), digest) for i, c, d, lab in out), key=str)


def found(df):
    return sorted(map(tuple, df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def test_query_against_loops(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert found(vectorcodes.op11_vector_codes(spark, sf_dir)) == brute(rows)


def test_odd_rows(spark):
    """Nulls in every column, odd sizes, ties, repeated rows, ids and labels; few entries, so that all rounds move them."""
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, 1) for _ in range(8)], k % 3) for k in range(150)]
    rows += [(k, rows[k][1], 1) for k in range(0, 150, 10)] + rows[:5]
    rows += [(200, None, 1), (201, [0.1] * 7 + [None], 1), (202, [float("nan")] * 8, 2), (203, [float("-inf")] + [0.0] * 7, 2)]
    rows += [(None, [0.5] * 8, None), (None, [0.25] * 8, None), (204, [0.1] * 3, 7), (205, [], 7), (206, [3e30] * 8, 1), (207, [-32767.5] * 8, 1), (208, [-0.0004] * 8, None)]
    rng.shuffle(rows)
    for entries in (256, 5, 1):
        assert found(vectorcodes.compressed(frame(spark, rows).repartition(5), entries=entries)) == brute(rows, entries=entries)


def test_sizes(spark):
    """A size that four does not divide, size 0, one row, none, and none that can be coded."""
    rng = random.Random(4)
    odd = [(k, [rng.gauss(0, 1) for _ in range(6)], None) for k in range(40)]
    for rows in (odd, [(1, [], 1), (2, [], 1)], [(7, [1.0, 2.0, 3.0, 4.0], 1)], [], [(1, [4e4] * 4, 1)], [(1, None, 1)]):
        assert found(vectorcodes.compressed(frame(spark, rows), entries=8)) == brute(rows, entries=8)


def test_a_common_vector(spark):
    """One vector a third of the rows: a task gives a row an entry, whatever it has read."""
    rows = [(k, [0.5, -0.5, 0.25, 1.0], 0) for k in range(300)] + [(k, [k / 7, -k / 9, 0.1, 0.2], 1) for k in range(300, 900)]
    assert found(vectorcodes.compressed(frame(spark, rows), entries=16)) == brute(rows, entries=16)
