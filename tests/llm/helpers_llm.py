"""Small document tables and brute-force versions of the operators."""
import random

EXTRA = ["id", "k", "h", "a", "b", "n", "x", "lo", "hi", "part", "line", "component", "_rank"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def documents(spark, texts, ids=None, langs=None):
    """A documents table with extra columns whose names clash with the operators' own."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, (langs or [None] * len(texts))[j], "s", len(t or ""), *[f"e{j}"] * len(EXTRA))
            for j, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", " ", "\n\n", "word", "Word", "two words", "\t\x0b\x0c tabs", "ÉTÉ été ß 漢字 😀", "x" * 3000,
       ("long text " * 4000).strip(), "a b c d e f g h i j k l", "A B C D E F G H I J K L", "...", "0 1 2", "<|endoftext|> mid <|endoftext|>"]


def words(text):
    return (text or "").encode().lower().split()


def shingle_set(text, w):
    ws = words(text)
    if not ws:
        return frozenset()
    return frozenset([tuple(ws)]) if len(ws) < w else frozenset(tuple(ws[i:i + w]) for i in range(len(ws) - w + 1))


def component_map(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n
    for a, b in links:
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def near_groups(texts, w, percent):
    sets = [shingle_set(t, w) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return sets, component_map(range(len(sets)), links)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def families(seed, base_words=60, sizes=(40, 12, 3, 2, 1, 1), vocab=400):
    """Texts in families of near copies, some passages shared between families."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(vocab)}"
    shared, out = [word() for _ in range(30)], []
    for size in sizes:
        base = [word() for _ in range(base_words)] + (shared if rnd.random() < 0.5 else [])
        for _ in range(size):
            t = list(base)
            for _ in range(rnd.randrange(0, 9)):
                t[rnd.randrange(len(t))] = word()
            out.append(" ".join(t))
    rnd.shuffle(out)
    return out
