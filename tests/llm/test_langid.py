"""The sample of languages that are full of copies."""

from genoweave.llm import langid


def test_language_of_copies_keeps_its_dictionary(spark):
    copies = spark.range(40000).selectExpr("if(id % 2 = 0, 'en', 'de') lang", "if(id % 2 = 0, 'the very same text', 'immer der gleiche text') text")
    other = spark.range(100).selectExpr("'de' lang", "concat('ein anderer satz ', id) text")
    unique = spark.range(600).selectExpr("'fr' lang", "concat('une phrase ', char(97 + id % 26), char(97 + id div 26)) text")
    known = langid.fit_dictionaries(copies.union(other).union(unique))
    assert list(known) == ["de", "en", "fr"] and known["en"] == b"the very same text"
    assert known["de"].count(b"anderer") == 100 and known["fr"].count(b"une phrase") == langid.SAMPLE_DOCS


def test_every_language_is_learned_unless_fewer_are_asked_for(spark):
    rows = spark.range(900).selectExpr("concat('l', id % 300) lang", "concat('words of ', char(97 + id % 26), ' tongue ', id) text")
    known = langid.fit_dictionaries(rows)
    assert len(known) == 300 and all(known.values())
    assert list(langid.fit_dictionaries(rows, languages=7)) == sorted(known)[:7]


def test_narrow_margins_are_decided_alike_at_every_length():
    known = {"x": b"alpha beta gamma delta " * 20, "y": b"eins zwei drei vier " * 20}
    classify = langid.Classifier(known)
    for n in (1, 40, 4000):
        text = " ".join(["alpha eins beta zwei"] * n)
        found = classify(text)
        assert found[0] in known and 0 <= found[1] <= 1
        assert classify(text + " alpha beta gamma delta" * n)[0] == "x"
    assert len(langid.endings(b"w " * 1000)) == langid.ENDINGS and langid.endings(b"a b") == [b"a b", b"b"]
