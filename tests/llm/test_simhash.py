"""SimHash components against brute force."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from kerbside.llm import common, simhash


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(items):
    """items: (id, fingerprint); least id reachable over links of four bits."""
    label = list(range(len(items)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(items)):
        for b in range(a):
            if (items[a][1] ^ items[b][1]).bit_count() <= 4:
                label[find(a)] = find(b)
    least = {}
    for at, (key, _) in enumerate(items):
        least[find(at)] = min(key, least.get(find(at), key))
    return {key: least[find(at)] for at, (key, _) in enumerate(items)}


def test_fingerprints():
    make = random.Random(3)
    texts = ["", " \n", "A b", "x", "a b c d", "É é\x0bz", "a\x1fb c"] + [" ".join(make.choices("ab Cd eF é\n ghi".split(" "), k=make.randrange(40))) for _ in range(200)]
    for text in texts:
        assert simhash.fingerprint(text.encode()) % 2**64 == plain_fingerprint(text)
    long = " ".join(str(i) for i in range(90_000))
    assert simhash.fingerprint(long.encode()) % 2**64 == plain_fingerprint(long)


def clusters():
    make = random.Random(11)
    found = [0, 1, 7]
    for _ in range(12):
        centre = make.getrandbits(64)
        found.append(centre)
        for _ in range(20):
            step = make.choice(found[-5:])
            for _ in range(make.randrange(0, 7)):
                step ^= 1 << make.randrange(64)
            found.append(step)
    return found + [make.getrandbits(64) for _ in range(100)]


def found_components(spark, values, dense):
    rows = [(i, simhash._signed(v)) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "doc_id long, fp long")
    return {r["doc_id"]: r["component_id"] for r in frame.join(simhash.classes(frame, dense), ["fp"]).collect()}


def test_components_by_blocks_and_by_midpoints(spark):
    values = clusters()
    expected = plain_components(list(enumerate(values)))
    assert found_components(spark, values, simhash.DENSE) == expected
    assert found_components(spark, values, 3) == expected


def test_every_pair_is_linked_once(spark):
    values = sorted({simhash._signed(v) for v in clusters()})
    table = simhash.pivot_table(spark.createDataFrame([(v,) for v in values], "fp long"))
    found = [(r["u"], r["v"]) for r in simhash.links(table).collect()]
    brute = {(a, b) for a in values for b in values if a < b and ((a ^ b) % 2**64).bit_count() <= 4}
    assert len(found) == len(set(found)) and set(found) == brute


def test_nulls_repeats_and_empty_table(spark):
    rows = [(5, None), (3, ""), (9, "same words here now"), (9, "same words here now"), (None, "same words here now"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", simhash.fingerprints("text").alias("fp"))
    out = frame.join(simhash.classes(frame), ["fp"]).collect()
    assert len(out) == len(rows)
    assert {r["component_id"] for r in out if r["fp"] == 0} == {3}
    assert {r["component_id"] for r in out if r["fp"] != 0} == {9}
    assert simhash.classes(frame.where(F.lit(False))).collect() == []


def test_rows_of_documents_are_never_broadcast(spark):
    """A small file may hold many rows once exploded, so its size is no reason to send it through the driver."""
    values = sorted({simhash._signed(v) for v in clusters()})
    rows = common.stored(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, fp long"), "fingerprints")
    table = common.stored(simhash.pivot_table(rows.select("fp")), "table")
    for found in (simhash.links(table), simhash.links(table, 3)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert not any("Broadcast" in line and "Inner" in line for line in plan.splitlines()), plan
    spread = simhash.classes(rows)._jdf.queryExecution().executedPlan().toString()
    assert not any("BroadcastHashJoin" in line and "LeftOuter" in line for line in spread.splitlines()), spread
