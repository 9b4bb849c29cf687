"""Counts against a plain Python version; outliers against planted ones."""

import random
import re

from kerbside.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def texts():
    make = random.Random(5)
    yield from ["", None, " \n\t", "a", "a b", "a a a a a", "a b c a b c", "é # | \x0b x\n\nx\nx", "    x", "a\n a\na", "x " * 5000]
    for _ in range(150):
        yield "".join(make.choice(["a ", "b ", "cé\n", "\t", "# ", "a b c ", "\x1f", "d\n"]) for _ in range(make.randrange(60)))


def test_counts(spark):
    rows = list(enumerate(texts()))
    frame = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", quality.statistics("text").alias("c"))
    found = {r["doc_id"]: r["c"] for r in frame.collect()}
    for at, text in rows:
        c = found[at]
        assert (c["n_words"], c["word_chars"], c["n_symbols"], c["n_dup_lines"], c["n_repeat_words"]) == plain(text), text


def judged(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, d2 string, g string, m0 string")
    frame = frame.select("*", quality.statistics("text").alias("c"))
    fitted = quality.fit(quality.vectors(frame, "c"))
    out = quality.verdict(frame, "c", fitted, "far").withColumn("kept", quality.accepted("c", "far"))
    return {r["doc_id"]: r for r in out.collect()}


def test_outliers_nulls_and_small_groups(spark):
    make = random.Random(7)
    words = ["".join(make.choices("abcdefgh", k=make.randrange(2, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(make.choices(words, k=n)).capitalize() + "."

    rows = [(i, prose(make.randrange(60, 300)), make.choice(["en", None]), make.choice(["a", "b", None]), "x", "y", "z") for i in range(600)]
    rows += [(1000 + i, "# | ".join(make.choices(words, k=80)), "en", "a", "x", "y", "z") for i in range(20)]
    rows += [(2000, None, None, None, "x", "y", "z"), (2001, "few words", "en", "a", "x", "y", "z"), (2002, prose(90), "xx", "rare", "x", "y", "z")]
    out = judged(spark, rows)
    assert all(out[i]["kept"] for i in range(600))
    assert not any(out[1000 + i]["kept"] for i in range(20))
    assert not out[2000]["kept"] and not out[2001]["kept"]
    assert out[2002]["kept"]
    assert len(out) == len(rows)


def test_repeated_words_alone_are_rejected(spark):
    make = random.Random(11)
    words = ["".join(make.choices("abcdefgh", k=make.randrange(2, 9))) for _ in range(400)]

    def line(n):
        return " ".join(make.choices(words, k=n))

    rows = [(i, line(make.randrange(500, 700)).capitalize() + ".", "en", "a", "x", "y", "z") for i in range(400)]
    phrase = line(150)
    rows += [(500, f"{phrase} {line(150)} {phrase} {line(150)}.".capitalize(), "en", "a", "x", "y", "z")]
    out = judged(spark, rows)
    assert all(out[i]["kept"] for i in range(400))
    assert 100 * out[500]["c"]["n_repeat_words"] <= 50 * out[500]["c"]["n_words"]  # the counts let it pass
    assert 30.856 < out[500]["far"] < 60 and not out[500]["kept"]


def test_few_texts_or_few_different_ones_make_no_outliers(spark):
    make = random.Random(17)
    words = ["".join(make.choices("abcdefgh", k=make.randrange(2, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(make.choices(words, k=n)).capitalize() + "."

    odd = prose(80).upper() + " # | $" * 9
    same = prose(90)
    few = [(i, prose(90), "en", "a", "x", "y", "z") for i in range(quality.FEWEST - 2)] + [(900, odd, "en", "a", "x", "y", "z")]
    out = judged(spark, few)
    assert all(row["kept"] and row["far"] is None for row in out.values())
    copies = [(i, same, "en", "a", "x", "y", "z") for i in range(300)] + [(900, odd, "en", "a", "x", "y", "z")]
    out = judged(spark, copies)
    assert all(row["kept"] and row["far"] is None for row in out.values())
    many = [(i, prose(90), "en", "a", "x", "y", "z") for i in range(300)] + [(900, odd, "en", "a", "x", "y", "z")]
    out = judged(spark, many)
    assert not out[900]["kept"] and sum(row["kept"] for row in out.values()) > 290


def test_floors_leave_wider_spreads_alone(spark):
    wide = {f"s{i}{j}": (4 * quality.FLOORS[i] ** 2 if i == j else 0.0) for i, j in quality.PAIRS}
    none = dict.fromkeys(wide, 0.0)
    names = ["g", *[f"m{i}" for i in range(5)], *wide]
    frame = spark.createDataFrame([("wide", *[0.0] * 5, *wide.values()), ("none", *[0.0] * 5, *none.values())], names)
    out = {r["g"]: r for r in quality._cholesky(frame).collect()}
    for i, floor in enumerate(quality.FLOORS):
        assert abs(out["wide"][f"l{i}{i}"] - 2 * floor) < 1e-9 and abs(out["none"][f"l{i}{i}"] - floor) < 1e-9


def test_empty_table(spark):
    assert judged(spark, []) == {}
