import pytest

#: Nulls, empty and very long texts, ties, repeated rows, odd white space.
TEXTS = [
    None, "", " \n\t ", "one", "a b", "Alpha beta gamma. " * 30, "Alpha beta gamma. " * 30, "x" * 30_000,
    " ".join(f"w{i}" for i in range(200)) + ".", "start " + " ".join(f"w{i}" for i in range(40, 120)) + " end.",
    " ".join(f"w{i}" for i in range(60, 140)) + "\n" + " ".join(f"v{i}" for i in range(30)), "é" * 80, "é" * 80 + "!", "home | about | news | login\nAll rights reserved.\nA plain line ends here.",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every awkward case, among them a null id, an id of two texts, and a row that is repeated as it is."""
    rows = [(i * 3, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, len(t or ""), "other", i) for i, t in enumerate(TEXTS)]
    rows += [rows[8], (rows[8][0], TEXTS[9], "de", "s1", 5, "other", 1), (None, TEXTS[8], "de", "s9", 5, "other", 1), (None, "lonely text of a few words", None, None, 1, "other", 2)]
    # extra columns whose names the operators use inside
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, tag string, fp int")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
