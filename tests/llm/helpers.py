"""Plain versions of the operators, and documents with odd cases."""

import re
from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, kept string, score string, component_id string, node string, t string, id string"
BLANK = r"[^\x20\x09-\x0D]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, ties, and other columns with names that operators use."""
    long = " ".join(f"word{i % 977} of{i}" for i in range(120_000))
    base = " ".join(f"w{i}" for i in range(80))
    texts = [None, "", "   \n\t ", base, base, base + " x", "a b c", "A B C", long, long + " end", "é" * 50, "Line one here.\nLine one here.\n\n" * 30, "<|endoftext|> a  b", base.upper()]
    rows = [(i, t, "en", None if i % 3 == 0 else "s", None, "clash", "clash", "clash", "clash", "clash", "clash", "clash") for i, t in enumerate(texts)]
    rows += [(3, base, "en", "s", 1, *["clash"] * 7), (None, base, None, None, None, *[None] * 7), (None, None, None, None, None, *[None] * 7)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, n=5):
    w = re.findall(BLANK, lower(text))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(docs):
    """The least id that each id reaches, by comparing all texts that share a shingle."""
    sets = {k: shingles(t) for k, t in docs.items()}
    parent = {k: k for k in docs}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    having = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            having[x].append(k)
    for k, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for j in having[x]:
                if j > k:
                    shared[j] += 1
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = top(k), top(j)
                parent[max(a, b)] = min(a, b)
    return {k: top(k) for k in docs}, {k: len(s) for k, s in sets.items()}


def contaminated(docs, items, window=10):
    """(words, hit words, items) of each document, by a table of all windows."""
    windows = defaultdict(set)
    for k, t in items.items():
        w = re.findall(WORD, lower(t))
        for i in range(max(1, len(w) - window + 1)) if w else ():
            windows[tuple(w[i : i + window])].add(k)
    lengths = {len(x) for x in windows}
    out = {}
    for k, t in docs.items():
        w = re.findall(WORD, lower(t))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if got := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= got
        out[k] = (len(w), len(hit), sorted(map(str, found)))
    return out


def base_counts(text):
    t = text or ""
    w = re.findall(BLANK, t)
    places = defaultdict(list)
    for i in range(len(w) - 2):
        places[tuple(w[i : i + 3])].append(i)
    again = {p + k for v in places.values() if len(v) > 1 for p in v for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(BLANK, x)]
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), failed
