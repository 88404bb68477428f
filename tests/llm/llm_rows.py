"""Made rows for the tests of the corpus operators."""

import os
import random

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROW = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, shard string, score string, row string"


def words(seed, n, sentence=9):
    r = random.Random(seed)
    out = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n)]
    return " ".join(w + "." if (i + 1) % sentence == 0 else w for i, w in enumerate(out))


def rows_of(texts, lang="en"):
    """Documents with columns of clashing names beside the usual ones."""
    return [(i, t, lang, None if i is None or i % 7 == 0 else f"s{i % 3}", len(t or ""), "x", "x", "x", "x", "x") for i, t in texts]
