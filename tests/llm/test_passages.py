"""Repeated passages of over 50 words, shorter than 400 bytes, leave the pipeline's third stage."""
import random
from collections import Counter

import corpus_pipeline
from panelspark.llm import suffix_dedup


def left(texts, n):
    """Words of each text that lie in no repeated passage of ``n`` words."""
    lists = [t.split() for t in texts]
    seen = Counter(tuple(w[i:i + n]) for w in lists for i in range(len(w) - n + 1))
    out = []
    for w in lists:
        gone = {j for i in range(len(w) - n + 1) if seen[tuple(w[i:i + n])] > 1 for j in range(i, i + n)}
        out.append([x for j, x in enumerate(w) if j not in gone])
    return out


def test_planted_passages(spark):
    rng = random.Random(3)

    def line(n):
        return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(1, 6))) for _ in range(n))

    long, short, letters = line(51), line(50), " ".join(rng.choice("abcdefgh") for _ in range(51))
    assert max(map(len, (long.encode(), short.encode(), letters.encode()))) < 400
    texts = [f" {line(40)} {long} {line(30)}", f"{line(7)}\n{long}\t{line(90)} ", f"{line(20)} {short} {line(20)}", f"{line(33)} {short} {line(9)}",
             letters, f"{line(12)}  {letters}", line(300), "", " ", "one"]
    cols = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], cols)
    got = {r.doc_id: r for r in corpus_pipeline.repeated_strings(spark, docs, "").collect()}
    want = left(texts, 51)
    assert {i: r.text.split() for i, r in got.items()} == {i: w for i, w in enumerate(want) if w or not texts[i].split()}
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert got[2].text == texts[2] and 4 not in got and long not in got[1].text


def test_passages_against_brute_force(spark):
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 999)}" for _ in range(150)]
    texts = []
    for _ in range(40):
        a = rng.randint(0, 110)
        texts.append(" ".join([*(f"x{rng.random()}" for _ in range(rng.randint(0, 9))), *base[a:a + rng.randint(5, 9)], *base[a + 5:a + rng.randint(10, 80)]]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text.split() for r in suffix_dedup.strip_repeats(docs, length=1 << 14, words=51).collect()}
    assert got == {i: w for i, w in enumerate(left(texts, 51)) if w}
