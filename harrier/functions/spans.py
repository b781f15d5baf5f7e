"""Dates and amounts in texts as spans, by a grammar of tokens, with the nearest word that tells what they are about.

A text is cut into numbers, words and signs with their places. Dates and amounts are read from neighbouring tokens, the
fuller form first, so spans never overlap. Whether a date is a deadline, or an amount a fine, follows from the clue words around a
span, by distance and by sentence. Words are compared in lower case without marks; an asterisk ends a stem.
"""

from __future__ import annotations

import datetime as dt
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Months of English, French, German, Spanish, Italian, Dutch, Portuguese, Polish, Czech, Slovak, Slovene,
#: Finnish, Swedish, Danish, Norwegian, Estonian, Latvian, Lithuanian, Romanian, Hungarian, Greek and Bulgarian.
MONTHS = {
    1: "jan janv januar* janvar* janvier january enero gennaio janeiro styczn* ledna leden tammikuu* jaanuar* sausi* ianuari* ιανουαρι* януари",
    2: "feb febr fevr februar* februari* fevrier february febrero febbraio fevereiro lut* unor* helmikuu* veebruar* vasari* φεβρουαρι* февруари",
    3: "mar march mars marz marzo maart marco marca marec marts marta martie marti marcius* brezn* maaliskuu* kovo μαρτι* март",
    4: "apr april* avril abril aprile kwietni* dubn* huhtikuu* aprill* balandz* απριλι* април",
    5: "may mai mayo maggio mei maio maj maja maje majus* maijs maija mai kvetn* toukokuu* geguz* μαιο* май",
    6: "jun june juin juni junio giugno junho czerwc* cervna cerven juna junij* junius juuni kesakuu* birzel* iunie ιουνι* юни",
    7: "jul july juillet juli julio luglio julho lipca lipiec cervenc* jula julij* julius juuli heinakuu* liepos iulie ιουλι* юли",
    8: "aug august* augusztus* avgust* aout agosto augusti augustus sierpni* srpna srpen elokuu* rugpjuc* αυγουστ* август",
    9: "sep sept septemb* septiembre settembre setembro wrzesni* zari syyskuu* rugsej* szeptember* σεπτεμβρι* септември",
    10: "oct okt octob* octombrie oktob* octubre ottobre outubro pazdziernik* rijna rijen lokakuu* spalio oktoober* οκτωβρι* октомври",
    11: "nov novemb* noviembre novembro listopad* marraskuu* lapkric* noiembrie νοεμβρι* ноември",
    12: "dec dez decemb* dezemb* diciembre dicembre dezembro desember grudni* gruodz* prosinc* joulukuu* detsember* δεκεμβρι* декември",
}
#: Euros for one unit of a currency, and the zone whose crowns are meant.
RATES = {"EUR": 1.0, "GBP": 1.17, "CHF": 1.07, "SEK": 0.092, "NOK": 0.085, "DKK": 0.134, "PLN": 0.235, "CZK": 0.040, "HUF": 0.0026, "USD": 0.92}
CROWNS = {"SE": "SEK", "NO": "NOK", "DK": "DKK"}
CURRENCIES = {
    "EUR": "€ eur euro* eura evro ευρω", "GBP": "£ gbp pound*", "CHF": "chf franken", "SEK": "sek", "NOK": "nok", "DKK": "dkk", "crowns": "kr kronor kroner",
    "PLN": "pln zł złot* zlot*", "CZK": "czk kc korun*", "HUF": "huf ft forint*", "USD": "$ usd dollar*",
}
TIMES = {
    1e3: "k thousand tsd mille mila tusen tusind tisic* tys ezer χιλιαδ*",
    1e6: "m mio mln million* millone* milhoe* milion* miljoen* miljon* miljoon* millio εκατ εκατομμυρι* mill milj",
    1e9: "bn mrd mld md billion* milliard* miliard* miljard* δισ δισεκατομμυρι*",
}
#: Stems of penalties, of a most that may be imposed, of obligations, of occasions, of steps that bind nobody, and of
#: consultations. Parameters of ``judged``; these are for the languages above.
PENALTIES = "fine fines fined fining penalt* sanction* sanzion* amende* condamn* bussgeld* bußgeld* strafe* geldbuße* sanktion* boete* multa* coima* kara karę kary grzywn* pokut* birsag* sakko* seuraamusmaksu* bøde* bot gebyr* προστιμ* глоб* amenz* globa trahv* bauda*".split()
CEILINGS = ["up to", "at most", "maximum", "jusqu'a", "bis zu", "hasta", "fino a", "ate", "tot", "do wysokosci", "az do", "legfeljebb", "εως", "enintaan", "op til", "upp till", "inntil", "pana la", "iki", "lidz", "kuni"]
DUTIES = "deadline* due must shall until appl* force mandatory obligat* requir* compl* transpos* submit* tard compter echeance* vigueur doivent devront frist* spatesten* kraft gilt verpflicht* plazo* vigor entro scadenz* prazo* uiterlijk* verplicht* termin* ucinnost* lhut* senast viimeist* voimaan hatarid* hataly* προθεσμ* ισχυ* срок* termen* tahta*".split()
OCCASIONS = "webina* conferen* congres* event* workshop* semina* forum* summit* meeting* colloqu* salon jornada* convegno tagung* konferen* veranstaltung* podcast reunion* hearing*".split()
STEPS = "consultation* consulta* consultazione vote* reading committee* comment* feedback stellungnahme* konsult* lausunto* remiss signed issued published".split()
BINDING = "force vigueur vigor comply compliance mandatory obligat* must shall transpos* kraft verpflicht* doivent devront voimaan hataly*".split()

_TOKEN = re.compile(r"\d+|[^\W\d_]+|\s+|.", re.DOTALL)
_SENTENCE = re.compile(r"(?<=[.!?;])\s+|\n+")


class Token(NamedTuple):
    start: int
    stop: int
    text: str


class Words:
    """Words and stems to a value each: a word is looked up whole, then by its beginnings, the longest first."""

    def __init__(self, table: dict):
        self.whole, self.stems, self.known = {}, {}, {}
        for value, words in table.items():
            for w in words.split() if isinstance(words, str) else words:
                (self.stems if w.endswith("*") else self.whole)[fold(w.rstrip("*"))] = value

    def get(self, word: str):
        if word not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            found = self.whole.get(word)
            for n in range(len(word), 2, -1) if found is None else ():
                if word[:n] in self.stems:
                    found = self.stems[word[:n]]
                    break
            self.known[word] = found
        return self.known[word]


def fold(text: str) -> str:
    """Lower case without marks, as long as the text: a letter that would become two stays one."""
    if text.isascii():
        return text.lower()
    out = []
    for c in text:
        bare = "".join(x for x in unicodedata.normalize("NFD", c.lower()) if unicodedata.category(x) != "Mn")
        out.append(bare if len(bare) == 1 else c)
    return "".join(out)


_MONTH, _CURRENCY, _TIMES = Words(MONTHS), Words(CURRENCIES), Words(TIMES)


def tokens(text: str) -> list[Token]:
    """Numbers, words and signs of a folded text; white space only parts them."""
    return [Token(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(text) if not m[0].isspace()]


def _day(y: int, m: int | None, d: int) -> dt.date | None:
    try:
        return dt.date(y, m or 0, d)
    except ValueError:
        return None


def _is_number(t: Token, least: int, most: int) -> bool:
    return t.text.isdigit() and least <= len(t.text) <= most


def dates(toks: list[Token]) -> list[tuple[int, int, dt.date, bool]]:
    """(start, stop, day, approx) of the days and months that are written out or in digits; impossible days are none."""
    out, i, n = [], 0, len(toks)
    at = lambda k: toks[k] if k < n else Token(-1, -1, "")
    small = ("de", "of", "del", "den", "the", "m", "gada", "г")

    def skip(k: int, more: tuple[str, ...]) -> int:
        while at(k).text in more:
            k += 1
        return k

    while i < n:
        found, a = None, at(i)
        if a.text.isdigit():
            # a day, with what may follow its number, and a month's name
            if len(a.text) <= 2:
                k = skip(i + 1, (".", "º", "er", "st", "nd", "rd", "th", "ος", *small))
                month = _MONTH.get(at(k).text)
                if month:
                    k = skip(k + 1, (".", ",", *small))
                    if _is_number(at(k), 4, 4):
                        found = (k, _day(int(at(k).text), month, int(a.text)), False)
                sign = at(i + 1).text
                if not found and sign in (".", "/", "-") and _is_number(at(i + 2), 1, 2) and at(i + 3).text == sign and _is_number(at(i + 4), 4, 4):
                    found = (i + 4, _day(int(at(i + 4).text), int(at(i + 2).text), int(a.text)), False)
            elif len(a.text) == 4:
                sign = at(i + 1).text
                if sign in ("-", ".", "/") and _is_number(at(i + 2), 1, 2) and at(i + 3).text == sign and _is_number(at(i + 4), 1, 2):
                    found = (i + 4, _day(int(a.text), int(at(i + 2).text), int(at(i + 4).text)), False)
                k = skip(i + 1, (".", ",", *small))
                month = _MONTH.get(at(k).text)
                if not found and month and _is_number(at(k + 1), 1, 2):
                    found = (k + 1, _day(int(a.text), month, int(at(k + 1).text)), False)
                elif not found and _is_number(at(k), 1, 2) and k > i + 1:
                    k2 = skip(k + 1, (".",))
                    if _MONTH.get(at(k2).text):
                        found = (k2, _day(int(a.text), _MONTH.get(at(k2).text), int(at(k).text)), False)
        elif _MONTH.get(a.text):
            k = skip(i + 1, (".",))
            if _is_number(at(k), 1, 2):
                y = skip(k + 1, ("st", "nd", "rd", "th", ",", "."))
                if _is_number(at(y), 4, 4):
                    found = (y, _day(int(at(y).text), _MONTH.get(a.text), int(at(k).text)), False)
            if not found:
                k = skip(i + 1, (".", ",", *small))
                if _is_number(at(k), 4, 4):
                    found = (k, _day(int(at(k).text), _MONTH.get(a.text), 1), True)
        if found:
            last, day, approx = found
            if day is not None and day.year >= 1900:
                out.append((a.start, toks[last].stop, day, approx))
            i = last + 1
        else:
            i += 1
    return out


def _number(toks: list[Token], i: int) -> tuple[float, int]:
    """The number that begins at a token, and the token behind it: groups of three digits, then a fraction."""
    digits, k = toks[i].text, i + 1

    def joined(sign: bool) -> bool:
        """Whether the next token goes on with the number: right behind one sign, or behind one space."""
        j = k + 1 if sign else k
        return j < len(toks) and toks[j].text.isdigit() and (toks[k].text in ".,'" and toks[k].start == toks[k - 1].stop and toks[j].start == toks[k].stop if sign else toks[k].start == toks[k - 1].stop + 1)

    if len(digits) <= 3:
        while k < len(toks):
            sign = toks[k].text in (".", ",", "'")
            if not joined(sign) or len(toks[k + 1 if sign else k].text) != 3:
                break
            digits += toks[k + 1 if sign else k].text
            k += 2 if sign else 1
    if k < len(toks) and toks[k].text in (".", ",") and joined(True):
        return float(f"{digits}.{toks[k + 1].text}"), k + 2
    return float(digits), k


def amounts(toks: list[Token], zone: str | None = None) -> list[tuple[int, int, float]]:
    """(start, stop, euros) of numbers with a currency in front or behind, and a word for thousands, millions or thousand millions
    between or behind, glued or not. Crowns are those of the zone, else Swedish. A bare year of this century is none."""
    out, i = [], 0

    def currency(word: str) -> str | None:
        code = _CURRENCY.get(word)
        return CROWNS.get(zone or "", "SEK") if code == "crowns" else code

    def glued(word: str) -> tuple[float, str] | None:
        """A unit and a currency in one word."""
        for n in range(1, len(word)):
            if _TIMES.get(word[:n]) and currency(word[n:]):
                return _TIMES.get(word[:n]), currency(word[n:])
        return None

    while i < len(toks):
        front = currency(toks[i].text)
        k = i + 1 if front else i
        if k < len(toks) and toks[k].text.isdigit() and not (k and toks[k - 1].text in (".", ",") and toks[k - 1].stop == toks[k].start and k > 1 and toks[k - 2].text.isdigit()):
            value, j = _number(toks, k)
            times, code, bare = 1.0, front, j == k + 1
            if j < len(toks):
                both = glued(toks[j].text)
                if both and not front:
                    times, code, j, bare = both[0], both[1], j + 1, False
                elif _TIMES.get(toks[j].text):
                    times, j, bare = _TIMES.get(toks[j].text), j + 1, False
                    j += j < len(toks) and toks[j].text == "."
            if not code:
                j2 = j
                while j2 < len(toks) and toks[j2].text in ("de", "di", "of", "d", "'", "’"):
                    j2 += 1
                if j2 < len(toks) and currency(toks[j2].text):
                    code, j = currency(toks[j2].text), j2 + 1
            if code and not (bare and re.fullmatch(r"20\d\d", toks[k].text)):
                out.append((toks[i].start, toks[j - 1].stop, value * times * RATES[code]))
                i = j
                continue
            i = max(j, i + 1)
            continue
        i += 1
    return out


class Clues:
    """The places of clue words in a text, to be asked for by distance."""

    def __init__(self, words: list[str]):
        self.words = Words({True: words})

    def of(self, toks: list[Token]) -> tuple[list[int], list[Token]]:
        held = [t for t in toks if self.words.get(t.text)]
        return [t.start for t in held], held

    @staticmethod
    def between(places: tuple[list[int], list[Token]], low: int, high: int) -> list[Token]:
        """The clue words that lie whole in low..high."""
        starts, held = places
        return [t for t in held[bisect_left(starts, low) : bisect_left(starts, high)] if t.stop <= high]


_PENALTY, _DUTY, _OCCASION, _STEP, _STRONG = (Clues(x) for x in (PENALTIES, DUTIES, OCCASIONS, STEPS, BINDING))


def read(text: str, zone: str | None = None) -> tuple[list[dict], list[dict]]:
    """The dates of a text, each with ``binding`` and the nearest word of a duty, and its amounts, each with ``fine``, ``most`` and
    the nearest word of a penalty.

    A date binds if a duty stands in the 110 characters before or 60 behind it and its sentence speaks of no occasion, and if the
    sentence has a binding word, or else there is no occasion around it, no mere step in 70 before or 40 behind, and the text
    does not open as a consultation. An amount of 1000 euros or more is a fine with a penalty in the 120 before or 80
    behind, and a most that may be imposed if the 40 characters before it say so.
    """
    low = fold(text)
    toks = tokens(low)
    found = dates(toks)
    days, sums = [], []
    if found:
        duty, occasion, step, strong = (c.of(toks) for c in (_DUTY, _OCCASION, _STEP, _STRONG))
        edges = [0, *[m.end() for m in _SENTENCE.finditer(low)], len(low) + 1]
        opening = bool(Clues.between(step, 0, 160)) and any(t.text.startswith(("consult", "konsult", "remiss", "lausunto")) for t in Clues.between(step, 0, 160))
        for start, stop, day, approx in found:
            near = Clues.between(duty, start - 110, stop + 60)
            k = bisect_left(edges, start + 1)
            sentence = edges[k - 1], edges[min(k, len(edges) - 1)]
            binding = bool(near) and not Clues.between(occasion, *sentence)
            if binding and not Clues.between(strong, *sentence):
                binding = not (Clues.between(occasion, start - 110, stop + 60) or Clues.between(step, start - 70, stop + 40) or opening)
            days.append({"start": start, "stop": stop, "day": day, "approx": approx, "binding": binding, "clue": _nearest(near, start, stop)})
    money = amounts(toks, zone)
    if money:
        penalty = _PENALTY.of(toks)
        for start, stop, euros in money:
            near = Clues.between(penalty, start - 120, stop + 80)
            before = low[max(0, start - 40) : start]
            most = any(re.search(rf"(?<!\w){re.escape(c)}(?!\w)", before) for c in CEILINGS)
            sums.append({"start": start, "stop": stop, "euros": euros, "fine": bool(near) and euros >= 1000, "most": most, "clue": _nearest(near, start, stop)})
    return days, sums


def _nearest(clues: list[Token], start: int, stop: int) -> str | None:
    return min(clues, key=lambda t: (max(start - t.stop, t.start - stop), t.start)).text if clues else None


DATES = "array<struct<start:int,stop:int,day:date,approx:boolean,binding:boolean,clue:string>>"
AMOUNTS = "array<struct<start:int,stop:int,euros:double,fine:boolean,most:boolean,clue:string>>"


def spans(df: DataFrame, key: str, text: str, zone: str | None = None) -> DataFrame:
    """(key, dates, amounts) of whole texts; places count characters from 0. A null text has neither."""
    some = df.select(F.col(key), F.col(text).alias("_text"), (F.col(zone).cast("string") if zone else F.lit(None).cast("string")).alias("_zone"))
    kind = df.schema[key].dataType.simpleString()
    day = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("day", pa.date32()), ("approx", pa.bool_()), ("binding", pa.bool_()), ("clue", pa.string())]))
    amount = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("euros", pa.float64()), ("fine", pa.bool_()), ("most", pa.bool_()), ("clue", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, zones = batch.column(1), batch.column(2)
            got = [read(texts[i].as_py() or "", zones[i].as_py()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got], day), pa.array([g[1] for g in got], amount)], [key, "dates", "amounts"])

    return some.mapInArrow(run, f"{key} {kind}, dates {DATES}, amounts {AMOUNTS}")


def largest_fine(found: DataFrame, key: str) -> DataFrame:
    """(key, fine, most): the largest fine of ``spans`` in whole euros, and whether it is a most that may be imposed."""
    best = F.array_max(F.transform(F.filter("amounts", lambda a: a["fine"]), lambda a: F.struct(a["euros"], a["most"])))
    return found.select(key, F.round(best["euros"]).cast("long").alias("fine"), best["most"].alias("most"))
