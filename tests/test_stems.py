"""Stems against words of the published vocabularies, and search by each item's language."""

import pytest

from seekframe.functions.snowball import STEMMERS
from seekframe.operators import textindex as X
from seekframe.operators.search import Items, search
from seekframe.plans.model import FieldSpec, IndexSpec, SpecError
from seekframe.plans.query import Query

# Words and their stems, from the sample vocabularies published with the algorithms.
PAIRS = {
    "german": "aufeinander aufeinand auferlegt auferlegt aufenthalt aufenthalt kategorie kategori kategorien kategori katers kat häuser haus freundlichkeit freundlich",
    "spanish": "cheque chequ chicas chic chicharrones chicharron toreado tor toreándolo tor torear tor torneo torne tormentas torment chihuahua chihuahu",
    "french": "continu continu continua continu continuait continu continuation continu continuellement continuel continué continu continuité continu majestueusement majestu majesté majest mains main maintenant mainten maintien maintien",
}


@pytest.mark.parametrize("config", PAIRS)
def test_published_stems(config):
    words = PAIRS[config].split()
    wrong = {w: STEMMERS[config](w) for w, s in zip(words[::2], words[1::2]) if STEMMERS[config](w) != s}
    assert not wrong
    for odd in ("", "a", "y", "ß", "uu", "quy", "12", "日本", "ss", "s", "ent", "e", "par", "niss"):
        assert isinstance(STEMMERS[config](odd), str)


def test_each_item_by_its_language(spark, tmp_path):
    index = IndexSpec("x", (FieldSpec("body", "text"),))
    rows = [("1", "n", "de", "die Kategorien"), ("2", "n", "es", "toreándolo ayer"), ("3", "n", "fr", "la continuation"), ("4", "n", "en", "working"), ("5", "n", None, "Kategorien working"), ("6", "n", "it", "continuation")]
    df = spark.createDataFrame(rows, "item_id string, datasource string, language string, body string")
    X.write(X.build(df, index, "language"), str(tmp_path), 2)
    items = Items(df, text={"language": X.read(spark, str(tmp_path))})
    find = lambda keys, lang: sorted(r.item_id for r in search(items, index, Query(keys=keys, config="language", languages=(lang,))).rows.collect())
    assert find("Kategorie", "de") == ["1"] and find("torear", "es") == ["2"] and find("continuait", "fr") == ["3"] and find("works", "en") == ["4"]
    assert find("continuation", "it") == ["6"] and find("continuait", "it") == []
    for bad in (None, ("de", "fr")):
        with pytest.raises(SpecError):
            search(items, index, Query(keys="x", config="language", languages=bad))
    with pytest.raises(SpecError):
        search(df, index, Query(keys="x", config="german"))
    with pytest.raises(SpecError):
        X.build(df, index, "latin")


def test_a_task_remembers_few_stems():
    """a task's memory of stems is bounded, and it is the only one of its worker."""
    from seekframe.functions.stem import porter

    porter.cache_clear()
    stem = X._stemmer("english")
    assert [stem(f"houses{chr(97 + k % 26)}ing", None) for k in range(26)] == [porter.__wrapped__(f"houses{chr(97 + k)}ing") for k in range(26)]
    assert porter.cache_info().currsize == 0 and X.STEMS <= 1 << 16
