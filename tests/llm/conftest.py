import random

import pytest

#: Words of four small invented languages.
SYLLABLES = {
    "de": "sch en er ung heit ver ich ein der lich".split(),
    "en": "the ing tion and er th ly ed on st".split(),
    "es": "cion ar os que el la do mente ue ía".split(),
    "fr": "eau oux elle ment re ç é ou ai tre".split(),
}


def words(lang: str, count: int, seed: int) -> list[str]:
    rnd = random.Random(f"{lang} {seed}")
    pick = lambda: "".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 3)))
    return [pick() for _ in range(count)]


@pytest.fixture(scope="session")
def prose():
    return lambda lang, count, seed=0: " ".join(words(lang, count, seed))


@pytest.fixture(scope="session")
def rows(spark):
    """Documents from (doc_id, text, lang, source) with a column named like results of several operators."""

    def make(items, schema="doc_id bigint, text string, lang string, source string"):
        return spark.createDataFrame([tuple(x) for x in items], schema)

    return make
