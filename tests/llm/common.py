"""Small inputs and brute-force helpers for the tests of this folder."""

from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; an input may have them as well.
CLASHES = ["record", "sender", "seq", "slot", "owner", "code", "fp", "key", "cell", "rep", "stats", "label", "fold", "score",
           "out", "ids", "length", "rank", "shard", "group_size", "keep_id", "text_sha256", "predicted", "component_id"]


def documents(spark, texts, schema=SCHEMA):
    """Rows of (id, text), or texts that are numbered from 0."""
    rows = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(texts)]
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], schema)


def clashing(df):
    """`df` with extra columns of clashing names and a null in each."""
    return df.selectExpr("*", *[f"cast(null as string) as {c}" for c in CLASHES if c not in df.columns])


def components(n, links):
    """Smallest member of the component of each of 0 .. n - 1."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def groups(pairs):
    out = defaultdict(list)
    for k, v in pairs:
        out[k].append(v)
    return out
