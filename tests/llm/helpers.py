"""Small tables with odd rows, and plain versions of the operators."""

import re
import zlib
from itertools import combinations

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, part int, key string, "
        "norm string, _row string, score double, `odd name` string")


def documents(spark, texts, ids=None):
    """Documents with extra columns whose names clash with the operators' own."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, None, "s", None if t is None else len(t), 1, "k", None, "r", 0.5, "o")
            for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


SENTENCE = "the quick brown fox jumps over the lazy dog while seven wizards quietly pack their boxes"
LONG = " ".join(f"w{k % 977} {SENTENCE}" for k in range(3000))
ODD = [None, "", " ", "A", "a", SENTENCE, SENTENCE.upper(), SENTENCE + ".", "É é ß 中文 🐶", "\n\t", LONG,
       LONG + " end", SENTENCE, "x" * 5000, None]
#: Identifiers with a null, a repeated row and a tie.
ODD_IDS = [0, 1, 2, 3, 4, 5, 6, 7, None, 9, 10, 11, 5, 13, 14]


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def alnum_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


def benchmark_hits(text, items):
    """(words, hit words, item identifiers) by looking every window up."""
    w, hit, met = alnum_words(text), set(), set()
    for i, t in items:
        v = alnum_words(t)
        n = min(13, len(v))
        for k in range(len(v) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == v[k:k + n]:
                    hit |= set(range(p, p + n))
                    met.add(str(i))
    return len(w), len(hit), sorted(met)


def simhash(text, digest):
    w = lower(text).encode().split()
    if not w:
        return 0
    h = [digest(b" ".join(w[k:k + 4]), 42) for k in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_of(prints, ids, bits):
    """Least identifier reachable over fingerprints within ``bits``."""
    of = {i: i for i in ids}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i
    for a, b in combinations(range(len(ids)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= bits:
            x, y = sorted((root(ids[a]), root(ids[b])))
            of[y] = x
    return {i: root(i) for i in ids}


def crc(data):
    return zlib.crc32(data)
