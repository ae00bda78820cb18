import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, spans string, size string"


@pytest.fixture
def docs(spark):
    """Documents of (id, text, lang, source) rows, with columns whose names the operators use."""

    def make(rows):
        full = [(i, t, l, s, None if t is None else len(t), "own", "own", "own") for i, t, l, s in rows]  # noqa: E741
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def odd():
    """Texts that every operator must bear: null, empty, blank, tiny, repeated, long, with clashing ids."""
    rng = random.Random(5)
    words = ["of", "the", "And", "über", "naïve", "x", "##", "12", "🙂", "lorem", "ipsum", "dolor"]
    text = lambda n: " ".join(rng.choice(words) + str(rng.randint(0, 30)) for _ in range(n))
    same, long = text(80), text(6000)
    rows = [
        (1, None), (2, ""), (3, " \t\n\r "), (4, "one"), (5, same), (6, same), (6, same), (7, same.upper()), (None, text(70)), (None, None),
        (8, long), (9, "a" * 3000), (10, "line\nline\n\nline\n" + text(60)), (11, same + " more words at the end"), (12, "\n".join([text(9)] * 40)),
        (13, long[:9000] + " " + text(100)), (14, "1234 5678 !!"), (8, text(30)), (15, text(300)), (15, same),
    ]
    sources = ["b", "a", None, "c"]
    return [(i, t, ["en", "de", None][k % 3], sources[k % 4]) for k, (i, t) in enumerate(rows)]
