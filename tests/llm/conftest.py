import pytest

from campaignry.session import local_frame

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i:03d}" for i in range(400)]


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns whose names clash with the operators' own."""
    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, 1, True, "x") for r in rows]
        return local_frame(spark, full, DOCS + ", size long, kept boolean, hash string")
    return build


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))
