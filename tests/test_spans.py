"""Spans of dates and amounts in the languages they know, and rules by automaton."""

import datetime as dt
import random
import re

import pytest

from harrier.functions import spans
from harrier.operators import rules


def days(text):
    return [d["day"] for d in spans.read(text)[0]]


#: The fifth day of each month of a year, as each language writes it, or of those months it gives.
WRITTEN = {
    "english": "5 January 2025, February 5, 2025, 5th March 2025, Apr 5 2025, May 5th, 2025, 5 june 2025, July 5, 2025, 5 August 2025, Sept. 5, 2025, 5 of October 2025, 5 Nov 2025, December 5 2025",
    "french": "5 janvier 2025, 5 février 2025, 5 mars 2025, 5 avril 2025, 5 mai 2025, 5 juin 2025, 5 juillet 2025, 5 août 2025, 5 septembre 2025, 5 octobre 2025, 5 novembre 2025, 5 décembre 2025",
    "german": "5. Januar 2025, 5. Februar 2025, 5. März 2025, 5. April 2025, 5. Mai 2025, 5. Juni 2025, 5. Juli 2025, 5. August 2025, 5. September 2025, 5. Oktober 2025, 5. November 2025, 5. Dezember 2025",
    "spanish": "5 de enero de 2025, 5 de febrero de 2025, 5 de marzo de 2025, 5 de abril de 2025, 5 de mayo de 2025, 5 de junio de 2025, 5 de julio de 2025, 5 de agosto de 2025, 5 de septiembre de 2025, 5 de octubre de 2025, 5 de noviembre de 2025, 5 de diciembre de 2025",
    "italian": "5 gennaio 2025, 5 febbraio 2025, 5 marzo 2025, 5 aprile 2025, 5 maggio 2025, 5 giugno 2025, 5 luglio 2025, 5 agosto 2025, 5 settembre 2025, 5 ottobre 2025, 5 novembre 2025, 5 dicembre 2025",
    "dutch": "5 januari 2025, 5 februari 2025, 5 maart 2025, 5 april 2025, 5 mei 2025, 5 juni 2025, 5 juli 2025, 5 augustus 2025, 5 september 2025, 5 oktober 2025, 5 november 2025, 5 december 2025",
    "portuguese": "5 de janeiro de 2025, 5 de fevereiro de 2025, 5 de março de 2025, 5 de abril de 2025, 5 de maio de 2025, 5 de junho de 2025, 5 de julho de 2025, 5 de agosto de 2025, 5 de setembro de 2025, 5 de outubro de 2025, 5 de novembro de 2025, 5 de dezembro de 2025",
    "polish": "5 stycznia 2025, 5 lutego 2025, 5 marca 2025, 5 kwietnia 2025, 5 maja 2025, 5 czerwca 2025, 5 lipca 2025, 5 sierpnia 2025, 5 września 2025, 5 października 2025, 5 listopada 2025, 5 grudnia 2025",
    "czech": "5. ledna 2025, 5. února 2025, 5. března 2025, 5. dubna 2025, 5. května 2025, 5. června 2025, 5. července 2025, 5. srpna 2025, 5. září 2025, 5. října 2025, 5. listopadu 2025, 5. prosince 2025",
    "slovak": "5. januára 2025, 5. februára 2025, 5. marca 2025, 5. apríla 2025, 5. mája 2025, 5. júna 2025, 5. júla 2025, 5. augusta 2025, 5. septembra 2025, 5. októbra 2025, 5. novembra 2025, 5. decembra 2025",
    "slovene": "5. januarja 2025, 5. februarja 2025, 5. marca 2025, 5. aprila 2025, 5. maja 2025, 5. junija 2025, 5. julija 2025, 5. avgusta 2025, 5. septembra 2025, 5. oktobra 2025, 5. novembra 2025, 5. decembra 2025",
    "finnish": "5. tammikuuta 2025, 5. helmikuuta 2025, 5. maaliskuuta 2025, 5. huhtikuuta 2025, 5. toukokuuta 2025, 5. kesäkuuta 2025, 5. heinäkuuta 2025, 5. elokuuta 2025, 5. syyskuuta 2025, 5. lokakuuta 2025, 5. marraskuuta 2025, 5. joulukuuta 2025",
    "swedish": "den 5 januari 2025, 5 februari 2025, 5 mars 2025, 5 april 2025, 5 maj 2025, 5 juni 2025, 5 juli 2025, 5 augusti 2025, 5 september 2025, 5 oktober 2025, 5 november 2025, 5 december 2025",
    "danish": "5. januar 2025, 5. februar 2025, 5. marts 2025, 5. april 2025, 5. maj 2025, 5. juni 2025, 5. juli 2025, 5. august 2025, 5. september 2025, 5. oktober 2025, 5. november 2025, 5. december 2025",
    "norwegian": "5. januar 2025, 5. februar 2025, 5. mars 2025, 5. april 2025, 5. mai 2025, 5. juni 2025, 5. juli 2025, 5. august 2025, 5. september 2025, 5. oktober 2025, 5. november 2025, 5. desember 2025",
    "estonian": "5. jaanuar 2025, 5. veebruar 2025, 5. märts 2025, 5. aprill 2025, 5. mai 2025, 5. juuni 2025, 5. juuli 2025, 5. august 2025, 5. september 2025, 5. oktoober 2025, 5. november 2025, 5. detsember 2025",
    "latvian": "2025. gada 5. janvārī, 2025. gada 5. februārī, 2025. gada 5. martā, 2025. gada 5. aprīlī, 2025. gada 5. maijā, 2025. gada 5. jūnijā, 2025. gada 5. jūlijā, 2025. gada 5. augustā, 2025. gada 5. septembrī, 2025. gada 5. oktobrī, 2025. gada 5. novembrī, 2025. gada 5. decembrī",
    "lithuanian": "2025 m. sausio 5 d., 2025 m. vasario 5 d., 2025 m. kovo 5 d., 2025 m. balandžio 5 d., 2025 m. gegužės 5 d., 2025 m. birželio 5 d., 2025 m. liepos 5 d., 2025 m. rugpjūčio 5 d., 2025 m. rugsėjo 5 d., 2025 m. spalio 5 d., 2025 m. lapkričio 5 d., 2025 m. gruodžio 5 d.",
    "romanian": "5 ianuarie 2025, 5 februarie 2025, 5 martie 2025, 5 aprilie 2025, 5 mai 2025, 5 iunie 2025, 5 iulie 2025, 5 august 2025, 5 septembrie 2025, 5 octombrie 2025, 5 noiembrie 2025, 5 decembrie 2025",
    "hungarian": "2025. január 5., 2025. február 5., 2025. március 5., 2025. április 5., 2025. május 5., 2025. június 5., 2025. július 5., 2025. augusztus 5., 2025. szeptember 5., 2025. október 5., 2025. november 5., 2025. december 5.",
    "greek": "5 Ιανουαρίου 2025, 5 Φεβρουαρίου 2025, 5 Μαρτίου 2025, 5 Απριλίου 2025, 5 Μαΐου 2025, 5 Ιουνίου 2025, 5 Ιουλίου 2025, 5 Αυγούστου 2025, 5 Σεπτεμβρίου 2025, 5 Οκτωβρίου 2025, 5 Νοεμβρίου 2025, 5 Δεκεμβρίου 2025",
    "bulgarian": "5 януари 2025, 5 февруари 2025, 5 март 2025, 5 април 2025, 5 май 2025, 5 юни 2025, 5 юли 2025, 5 август 2025, 5 септември 2025, 5 октомври 2025, 5 ноември 2025, 5 декември 2025 г.",
    "digits": "2025-01-05, 5.2.2025, 05/03/2025, 2025. 04. 05., 5-5-2025, 2025/06/05, 5. 7. 2025, 05.08.2025, 2025.09.05, 5/10/2025, 2025-11-05, 5.12.2025",
}


@pytest.mark.parametrize("language", list(WRITTEN))
def test_dates(language):
    assert days(WRITTEN[language]) == [dt.date(2025, m, 5) for m in range(1, 13)]


def test_other_dates():
    found = {t: [(d["day"].isoformat(), d["approx"]) for d in spans.read(t)[0]] for t in ("in May 2024", "31.02.2024", "May 5 people marched", "1er mai 2024", "version 2025.1.2.3", "março de 2023, 3rd of June 2024", "12.05.2024-13.05.2024", "")}
    assert found == {
        "in May 2024": [("2024-05-01", True)], "31.02.2024": [], "May 5 people marched": [], "1er mai 2024": [("2024-05-01", False)], "version 2025.1.2.3": [("2025-01-02", False)],
        "março de 2023, 3rd of June 2024": [("2023-03-01", True), ("2024-06-03", False)], "12.05.2024-13.05.2024": [("2024-05-12", False), ("2024-05-13", False)], "": [],
    }
    text = "Ärger: 5. März 2025!"
    d = spans.read(text)[0][0]
    assert text[d["start"] : d["stop"]] == "5. März 2025"


def test_binding_dates():
    far = "It is a long and plain text that says nothing of what anybody has to do, and it goes on in that way for quite a while, on and on. "
    told = {
        "Firms must report by 1 June 2024.": True,
        "A webinar on what firms must do is on 1 June 2024.": False,
        "At the workshop: the act enters into force. " + far + "Applies from 1 June 2024.": True,
        "Comments are due by 1 June 2024, after the vote.": False,
        "Consultation on toys. " + far + far + "Answers due 1 June 2024.": False,
        "Consultation on toys. " + far + far + "Firms must comply by 1 June 2024.": True,
        "must " + far + "1 June 2024": False,
        "Frist bis zum 1. Juni 2024": True,
        "au plus tard le 1 juin 2024": True,
    }
    assert {t: spans.read(t)[0][0]["binding"] for t in told} == told
    near = spans.read("They must, and shall, act by 1 June 2024")[0][0]
    assert near["clue"] == "shall"


def test_amounts_by_language_and_zone():
    told = {
        "fined SEK 5 million": 460_000, "Bußgeld von 5 Mio. Euro": 5_000_000, "2005 euros fine": None, "amende de 1,5 million d'euros": 1_500_000, "boete van 3 miljoen euro": 3_000_000, "multa de 2.500.000 €": 2_500_000,
        "sanzione di 20 milioni di euro": None, "kara 4 mln zł": 940_000, "pokuta 10 milionů Kč": 400_000, "10 millió Ft bírság": 26_000, "bøde på 500.000 kr": 46_000, "fine of CHF 2'000'000": 2_140_000, "5 MSEK sanktionsavgift": 460_000,
        "πρόστιμο 2 εκατ. ευρώ": 2_000_000, "a fine of $3bn": 2_760_000_000, "sakko 5 miljoonaa euroa": None, "a price of 5 million euros": None, "fine: 1999 euros": 1_999,
    }

    def largest(text, zone=None):
        return max((round(a["euros"]) for a in spans.read(text, zone)[1] if a["fine"]), default=None)

    assert {t: largest(t) for t in told} == told | {"sanzione di 20 milioni di euro": 20_000_000, "sakko 5 miljoonaa euroa": 5_000_000}
    assert [largest("bøde på 500.000 kr", z) for z in ("DK", "NO", "SE", None)] == [67_000, 42_500, 46_000, 46_000]
    most = {t: [a["most"] for a in spans.read(t)[1]] for t in ("fines of up to 10 million euros", "bis zu 5 Mio. Euro Strafe", "a fine of 10 million euros", "upton 5 euros")}
    assert most == {"fines of up to 10 million euros": [True], "bis zu 5 Mio. Euro Strafe": [True], "a fine of 10 million euros": [False], "upton 5 euros": [False]}


def test_spans_of_rows(spark):
    rows = [(1, "fined 2 million euros on 1 May 2024", "SE"), (2, None, None), (3, "", None), (3, "fined 9 MSEK", "SE"), (4, "x " * 100_000 + "fine of up to 3000 kr", "DK")]
    df = spark.createDataFrame(rows, "id int, text string, zone string").repartition(3)
    found = spans.spans(df, "id", "text", "zone")
    got = sorted(((r["id"], r["fine"], r["most"]) for r in spans.largest_fine(found, "id").collect()), key=repr)
    assert got == [(1, 2_000_000, False), (2, None, None), (3, 828_000, False), (3, None, None), (4, None, None)]
    assert [len(r["dates"]) for r in found.where("id = 1").collect()] == [1]
    assert spans.spans(df.limit(0), "id", "text").count() == 0


def test_literals_are_in_every_match():
    rng = random.Random(1)
    told = {r"\blicen[sc]e": ["licen"], "a|bcd": [], r"\bfoo\w*|bars?": ["bar", "foo"], "ab?cd+e": ["cd"], "(?:x|y)zz": ["zz"], "(?<=a)bcd": [], "abc{2}def": ["def"], r"a\.b\|c": ["a.b|c"], "[ab]+": [], "(ab(c|d)e)?fg": ["fg"]}
    assert {p: rules.literals(p) for p in told} == told
    for p, some in told.items():
        for _ in range(300):
            text = "".join(rng.choice("abcdefglnorsxyz.| ") for _ in range(30))
            if some and re.search(p, text):
                assert any(s in text for s in some)


def test_rules_by_automaton(spark):
    some = [rules.Rule("a", "f", r"\bfoo\w*", 2), rules.Rule("b", "f", "ba[rz]"), rules.Rule("c", "g", "[0-9]+"), rules.Rule("d", "h", "never")]
    df = spark.createDataFrame([(1, "Foo foobar BÁZ 12 7"), (2, None), (3, ""), (4, "none here"), (1, "afoo")], "id int, text string")
    got = sorted(((r["id"], r["codes"], r["scores"]) for r in rules.codes(df, "id", "text", some).collect()), key=repr)
    assert got == sorted([(1, {"f": ["a", "b"], "g": ["c"]}, {"f": 6, "g": 2}), (1, {}, {}), (2, {}, {}), (3, {}, {}), (4, {}, {})], key=repr)
    rng = random.Random(2)
    many = [rules.Rule(f"r{i}", f"f{i % 5}", "".join(rng.choice("abc") for _ in range(3)) + rng.choice(["", "?", "[ab]", "|b+c"])) for i in range(60)]
    known = rules.RuleSet(tuple(many))
    for _ in range(200):
        text = "".join(rng.choice("abc ") for _ in range(40))
        assert known.hits(text) == [(i, len(re.findall(r.pattern, text))) for i, r in enumerate(many) if re.search(r.pattern, text)]
