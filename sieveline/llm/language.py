"""Languages of texts and of their segments, with a confidence (problem 2).

Method: cross-parsing entropy. For each language a suffix automaton holds running labelled text. A segment is cut
greedily into phrases, each the longest match that the automaton gives, across words and spaces; a segment in the
automaton's language needs few of them. The cost of a language is its number of phrases times log2 of the size of its
labelled text, over that of a full one, and the language of least cost wins. The automata of the languages that share a
script are tables of transitions, and all segments of a batch are parsed side by side in numpy, a character a step, the
longest first. Where a script has one language (Korean, Russian), that is the language.

The labels of the corpus are partly wrong. The model starts from a short text of our own for each language; a bounded
sample of labelled rows (at most ``SAMPLE_ROWS``, those of the lowest hash) then gives the running text of the segments
whose label agrees with that start, of each language the first ``TEXT_CHARS`` characters. Only these texts (at most
12 x ``TEXT_CHARS`` characters) go to the workers.

Defined results: a null, empty or letterless text has no language. A garbled text is repaired first. Segments of under
``MIN_LETTERS`` letters, under three words or of a margin under ``MIN_MARGIN`` phrases have no language of their own. Whole texts are
examined. Rows delivered twice give one result for each distinct value.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .encoding import as_fields, garble
from .lookalike import forms

LANGS = ["en", "de", "fr", "es", "pt", "it", "nl", "pl", "ru", "ko", "ja", "zh"]
SAMPLE_ROWS, TEXT_CHARS = 5_000, 16_000
MIN_LETTERS, MIN_MARGIN, WHOLE_MARGIN, STRANGE = 8, 1.5, 0.4, 0.55
#: Phrases by which the start must prefer another language to contradict a label.
DOUBT = 4.0
MIXED = re.compile("[Ͱ-ԯ](?:(?=[A-Za-z])|(?<=[A-Za-z].))")
PART_ROWS = 2_000

# Other notations of the languages.
NOTATIONS = {
    "en": "eng english", "de": "deu ger german deutsch", "fr": "fra fre french français", "es": "spa spanish español castilian", "pt": "por portuguese português", "it": "ita italian italiano",
    "nl": "nld dut dutch nederlands", "pl": "pol polish polski", "ru": "rus russian русский", "ko": "kor korean 한국어", "ja": "jpn jp japanese 日本語", "zh": "zho chi cmn chinese 中文",
}
CANONICAL = {n: k for k, v in NOTATIONS.items() for n in [k, *v.split()]}

#: A few lines of everyday prose for each language, to tell which labels can be trusted.
START = {
    "en": "when my grandmother moved into the little house behind the bakery she brought only two suitcases and an old clock that had never been repaired. nobody could remember who gave it to her, but it was always standing on the shelf between the window and the door. she used to say that a room without a clock is like a street without people. every morning we walked to school together, and if there was enough time she would tell us what the town looked like before the railway came. i think they were happier than they knew, although their winters must have been long and cold. you should have seen how those neighbours helped each other whenever somebody fell ill. some of them still write letters, because this is how it has always been done, more or less, from one year to another, with or without us. how do our children, their friends and its many uses change over time and under what conditions, within or through which we are not able to see",
    "de": "als meine großmutter in das kleine haus hinter der bäckerei zog, brachte sie nur zwei koffer und eine alte uhr mit, die niemand jemals repariert hatte. keiner wusste mehr, wer sie ihr geschenkt hatte, aber sie stand immer auf dem regal neben dem fenster. sie sagte oft, ein zimmer ohne uhr sei wie eine straße ohne menschen. jeden morgen gingen wir zusammen zur schule, und wenn wir noch genug zeit hatten, erzählte sie uns, wie die stadt aussah, bevor die eisenbahn kam. ich glaube, dass die leute damals glücklicher waren, obwohl ihre winter lang und kalt gewesen sein müssen. man hätte sehen sollen, wie sich die nachbarn gegenseitig halfen, wenn jemand krank wurde. einige von ihnen schreiben noch heute briefe, weil das schon immer so gemacht worden ist, mal mehr, mal weniger, von einem jahr zum anderen, mit uns oder ohne uns. können wir daher auch unter solchen bedingungen durch eine neue messung zeigen, ob sich etwas im vergleich verändert",
    "fr": "quand ma grand-mère est venue habiter la petite maison derrière la boulangerie, elle n'avait que deux valises et une vieille horloge que personne n'avait jamais réparée. on ne savait plus qui la lui avait donnée, mais elle restait toujours sur l'étagère, entre la fenêtre et la porte. elle disait souvent qu'une chambre sans horloge est comme une rue sans passants. chaque matin nous allions ensemble à l'école et, s'il nous restait assez de temps, elle nous racontait comment était la ville avant l'arrivée du chemin de fer. je crois que les gens étaient plus heureux qu'ils ne le pensaient, même si leurs hivers devaient être longs et froids. il fallait voir comme ces voisins s'aidaient les uns les autres dès que quelqu'un tombait malade. certains d'entre eux écrivent encore des lettres, parce que cela s'est toujours fait ainsi, plus ou moins, d'une année à l'autre, avec ou sans nous. cette façon de faire est-elle utile aux enfants, et peut-on la comparer avec celle du pays voisin",
    "es": "cuando mi abuela se mudó a la casita que está detrás de la panadería, solo trajo dos maletas y un reloj viejo que nadie había arreglado nunca. ya no sabíamos quién se lo había regalado, pero siempre estaba en el estante, entre la ventana y la puerta. ella decía que una habitación sin reloj es como una calle sin gente. todas las mañanas íbamos juntos a la escuela y, si nos quedaba tiempo, nos contaba cómo era el pueblo antes de que llegara el ferrocarril. creo que eran más felices de lo que pensaban, aunque sus inviernos debían de ser largos y fríos. había que ver cómo se ayudaban los vecinos cuando alguno caía enfermo. algunos de ellos todavía escriben cartas, porque así se ha hecho siempre, más o menos, de un año a otro, con nosotros o sin nosotros. es posible que esto también sirva para los niños, y se puede comparar con lo que hacen en el país vecino mediante una nueva medición",
    "pt": "quando a minha avó se mudou para a casinha que fica atrás da padaria, trouxe apenas duas malas e um relógio velho que ninguém tinha consertado. já não sabíamos quem lho tinha oferecido, mas ele estava sempre na prateleira, entre a janela e a porta. ela dizia que um quarto sem relógio é como uma rua sem gente. todas as manhãs íamos juntos à escola e, se ainda houvesse tempo, ela contava-nos como era a vila antes de chegar o comboio. acho que as pessoas eram mais felizes do que pensavam, embora os seus invernos devessem ser longos e frios. era preciso ver como os vizinhos se ajudavam quando alguém ficava doente. alguns deles ainda escrevem cartas, porque sempre se fez assim, mais ou menos, de um ano para o outro, conosco ou sem nós. será que isso também serve para as crianças, e não se pode comparar com aquilo que fazem no país vizinho por meio de uma nova medição",
    "it": "quando mia nonna venne ad abitare nella casetta dietro il forno, portò con sé soltanto due valigie e un vecchio orologio che nessuno aveva mai riparato. non si sapeva più chi glielo avesse regalato, ma stava sempre sullo scaffale, tra la finestra e la porta. diceva che una stanza senza orologio è come una strada senza gente. ogni mattina andavamo insieme a scuola e, se c'era ancora tempo, ci raccontava com'era il paese prima che arrivasse la ferrovia. credo che fossero più felici di quanto pensassero, anche se i loro inverni dovevano essere lunghi e freddi. bisognava vedere come i vicini si aiutavano quando qualcuno si ammalava. alcuni di loro scrivono ancora delle lettere, perché si è sempre fatto così, più o meno, da un anno all'altro, con noi o senza di noi. questo può servire anche ai bambini, e lo si può confrontare con quello che fanno gli altri nel paese vicino per mezzo di una nuova misura",
    "nl": "toen mijn grootmoeder in het huisje achter de bakkerij ging wonen, bracht ze alleen twee koffers mee en een oude klok die nog nooit iemand had gemaakt. niemand wist meer van wie ze die gekregen had, maar hij stond altijd op de plank tussen het raam en de deur. ze zei vaak dat een kamer zonder klok net een straat zonder mensen is. elke ochtend liepen we samen naar school en als er nog genoeg tijd over was, vertelde ze ons hoe het dorp eruitzag voordat de spoorweg kwam. ik denk dat zij gelukkiger waren dan ze zelf wisten, hoewel hun winters lang en koud moeten zijn geweest. je had moeten zien hoe die buren elkaar hielpen zodra er iemand ziek werd. sommigen van hen schrijven nog steeds brieven, omdat het nu eenmaal altijd zo gedaan is, min of meer, van het ene jaar op het andere, met of zonder ons. kunnen wij dit ook gebruiken voor onze kinderen, en is het mogelijk om een nieuwe meting te vergelijken met wat men bij de buren doet",
    "pl": "kiedy moja babcia wprowadziła się do małego domu za piekarnią, przywiozła tylko dwie walizki i stary zegar, którego nikt nigdy nie naprawił. nie pamiętaliśmy już, kto go jej podarował, ale zawsze stał na półce między oknem a drzwiami. mówiła, że pokój bez zegara jest jak ulica bez ludzi. każdego ranka chodziliśmy razem do szkoły, a jeśli starczyło czasu, opowiadała nam, jak wyglądało miasteczko, zanim zbudowano kolej. myślę, że byli szczęśliwsi, niż im się wydawało, chociaż ich zimy musiały być długie i mroźne. trzeba było widzieć, jak sąsiedzi pomagali sobie nawzajem, gdy ktoś zachorował. niektórzy z nich wciąż piszą listy, ponieważ tak się zawsze robiło, mniej lub bardziej, z roku na rok, z nami albo bez nas. czy można to również wykorzystać dla dzieci i porównać z tym, co robią w sąsiednim kraju przy pomocy nowych pomiarów, oraz od czego zależy ich wpływ na te zmiany",
    "ru": "когда моя бабушка переехала в маленький дом за пекарней, она привезла с собой только два чемодана и старые часы, которые никто никогда не чинил. уже никто не помнил, кто их подарил, но они всегда стояли на полке между окном и дверью.",
    "ko": "할머니가 빵집 뒤의 작은 집으로 이사하실 때 가방 두 개와 낡은 시계 하나만 가져오셨다. 누가 그 시계를 주었는지는 아무도 기억하지 못했지만 언제나 창문 옆 선반 위에 놓여 있었다.",
    "ja": "祖母がパン屋の裏にある小さな家へ引っ越したとき、持ってきたのは二つの鞄と、だれも直したことのない古い時計だけだった。それをだれにもらったのかはもう覚えていなかったが、時計はいつも窓と戸の間の棚に置かれていた。時計のない部屋は人のいない通りのようなものだとよく言っていた。毎朝いっしょに学校まで歩き、時間があれば鉄道が来る前の町の様子を話してくれた。",
    "zh": "祖母搬到面包店后面的小房子时，只带来了两个箱子和一个从来没有人修过的旧钟。谁也不记得是谁送给她的，但是它总是放在窗户和门之间的架子上。她常说，没有钟的房间就像没有人的街道。每天早上我们一起走路去上学，如果还有时间，她就给我们讲铁路修到这里以前镇上是什么样子。我觉得他们比自己知道的要快乐，虽然那时的冬天一定又长又冷。",
}

WORD = re.compile(r"[^\W\d_]+")
# Marks that end a segment; each pattern begins with its characters, so that a search stops only there.
SENTENCE = r"[.!?…。！？\n\r  |](?:(?<=[。！？\n\r  |])|(?=[\"”»’)]?\s))"
TITLE_PART = r"[=/|\[\]()\n\r  ](?:(?<=[|\[\]()\n\r  ])|(?<=\s[=/])(?=\s))"
TEXT_END = "\x01"
SPLIT = {True: re.compile(TITLE_PART), False: re.compile(SENTENCE)}
# The same marks by character, for whole batches: those that always end a segment and those that may.
LETTER, SPACE, ALWAYS, MAYBE, CLOSE = 1, 2, 4, 8, 16
#: Bits of a character's mark from which its script (three bits) and its code in the tables stand.
SCRIPT_AT, CODE_AT = 5, 8
ALWAYS_END = {True: "|[]()\n\r\u2028\u2029", False: "。！？\n\r\u2028\u2029|"}
MAYBE_END = {True: "=/", False: ".!?…"}
INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
ODD_FORMS = re.compile("[\\xad\\u200b-\\u200d\\u2060\\ufeff\\u0300-\\u036f\\uff01-\\uff5e\\ufb00-\\ufb06]")
#: What ``_plain`` changes holds one of the two or ``TEXT_END``; RE2, run by Arrow over whole batches.
MAY_BE_ODD = r"[\x{ad}\x{200b}-\x{200d}\x{2060}\x{feff}\x{300}-\x{36f}\x{ff01}-\x{ff5e}\x{fb00}-\x{fb06}\x{1}]|[\x{370}-\x{52f}][A-Za-z]|[A-Za-z][\x{370}-\x{52f}]"


def canonical_label(label: str | None) -> str | None:
    """The one of the twelve languages that a label names, in whatever notation; None if it names none or several."""
    if not label:
        return None
    low = label.strip().lower()
    if low in CANONICAL:
        return CANONICAL[low]
    m = re.fullmatch(r"([a-z]{2,3})(?:[-_][a-z0-9]{2,8})+", low)
    return CANONICAL.get(m.group(1)) if m else None


class SuffixAutomaton:
    """All substrings of a text; one dictionary of transitions a state."""

    def __init__(self, text: str) -> None:
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            new = len(self.next)
            self.next.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p != -1 and c not in self.next[p]:
                self.next[p][c] = new
                p = link[p]
            if p != -1:
                q = self.next[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p != -1 and self.next[p].get(c) == q:
                        self.next[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        self.bits = math.log2(len(text) + 2)

    def phrases(self, text: str) -> int:
        """Number of phrases of the greedy parse; a character never met is a phrase, and one more for the surprise."""
        n, i, out = len(text), 0, 0
        nodes = self.next
        while i < n:
            state, j = 0, i
            while j < n and (to := nodes[state].get(text[j])) is not None:
                state = to
                j += 1
            out += 1 if j > i else 2
            i = j if j > i else i + 1
        return out


LATIN, HAN = range(8), range(10, 12)
#: Code of a character that no automaton of the script holds.
UNKNOWN = 0


class Tables:
    """Automata of several languages as one array of transitions, and the parse of many segments side by side.

    A state is the place of its row in the array, so a step is one lookup; a negative number ends a phrase and begins the
    next one. A character that a language doesn't hold is a phrase and starts none.
    """

    def __init__(self, automata: list[SuffixAutomaton]) -> None:
        letters = sorted({c for a in automata for t in a.next for c in t})
        self.code = np.full(1 << 16, UNKNOWN, np.int32)  # as wide as a state, or each step would convert all codes
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        size = len(letters) + 1
        rows = sum(len(a.next) for a in automata)
        self.to = np.full(rows * size, -1, np.int32)
        self.root = np.zeros(len(automata), np.int32)
        at = 0
        place = {c: i + 1 for i, c in enumerate(letters)}
        for k, a in enumerate(automata):
            self.root[k] = at * size
            for state, steps in enumerate(a.next):
                for c, to in steps.items():
                    self.to[(at + state) * size + place[c]] = (at + to) * size
            at += len(a.next)
        # where a phrase ends the table holds, with all bits turned, the state in which the next one begins
        first = self.to[self.root[:, None] + np.arange(size)]
        first = np.where(first < 0, self.root[:, None], first).astype(np.int32)
        begin = self.root // size
        for k, (low, high) in enumerate(zip(begin, [*begin[1:], rows])):
            part = self.to[low * size : high * size].reshape(-1, size)
            np.copyto(part, ~first[k], where=part < 0)

    def phrases(self, codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Phrases of each span in each language: (span, language)."""
        order = np.argsort(begin - end, kind="stable")  # the longest first
        begin, size = begin[order], (end - begin)[order]
        counts = np.zeros((len(begin), len(self.root)), np.int32)
        state = np.repeat(self.root[None, :], len(begin), axis=0)
        spare, ends = np.empty_like(state), np.empty_like(state)
        alive = len(begin) - np.searchsorted(size[::-1], np.arange(1, (size[0] if len(size) else 0) + 1), "left")
        for t, k in enumerate(alive.tolist()):
            now, to, dead = state[:k], spare[:k], ends[:k]
            now += codes[begin[:k] + t][:, None]
            np.take(self.to, now, out=to, mode="clip")
            np.right_shift(to, 31, out=dead)  # -1 where a phrase ends
            np.bitwise_xor(to, dead, out=now)
            counts[:k] -= dead
        out = np.empty_like(counts)
        out[order] = counts + 1
        return out


#: Stands for a letter above the basic plane; no automaton holds it.
FAR_LETTER = 0xA7FF


def _letters_of(text: str) -> np.ndarray:
    """Code points of a text; above the basic plane one letter stands for all letters and 0 for the rest."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    far = np.flatnonzero(points >= 1 << 16)
    if len(far):
        points = points.copy()
        points[far] = [FAR_LETTER if chr(c).isalnum() and not chr(c).isdecimal() else 0 for c in points[far].tolist()]
    return points


class Model:
    """Automata of all languages over running text, and costs of segments in phrases normalised to a full text."""

    def __init__(self, texts: dict[str, str]) -> None:
        held = {k: f" {texts[k]} " for k in (*range(8), *range(10, 12)) for k in [LANGS[k]]}
        automata = {k: SuffixAutomaton(t) for k, t in held.items()}
        full = math.log2(TEXT_CHARS)
        self.scale = np.array([automata[k].bits / full if k in automata else 1.0 for k in LANGS])
        self.latin = Tables([automata[LANGS[k]] for k in LATIN])
        self.han = [automata[LANGS[k]] for k in HAN]
        script = np.zeros(1 << 16, np.int32)  # 1 Latin, 2 Cyrillic, 3 Hangul, 4 Han and kana
        for low, high, number in ((0x41, 0x2B0, 1), (0x1E00, 0x1F00, 1), (0x400, 0x530, 2), (0xAC00, 0xD7A4, 3), (0x1100, 0x1200, 3), (0x3040, 0x3100, 4), (0x3400, 0xA000, 4), (0x3005, 0x3006, 4)):
            script[low:high] = number
        alpha = np.array([chr(i).isalnum() and not chr(i).isdecimal() for i in range(1 << 16)])
        space = np.array([chr(i).isspace() for i in range(1 << 16)])
        # what a character is, its script and its code in the tables as one number, so that a text is looked up once
        self.marks = {}
        for titles in (True, False):
            kind = np.where(alpha, LETTER, 0) | np.where(space, SPACE, 0)
            for chars, what in ((ALWAYS_END[titles] + TEXT_END, ALWAYS), (MAYBE_END[titles], MAYBE), ("\"”»’)", CLOSE)):
                kind[[ord(c) for c in chars]] |= what
            self.marks[titles] = (kind | script << SCRIPT_AT | self.latin.code << CODE_AT).astype(np.int32)

    def parse(self, texts: list[str], titles: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All segments of all texts: (text number, cost of each language, letters, words).

        A syllable or ideograph counts as three letters. Segments without a word are left out.
        """
        joined = TEXT_END.join([*texts, ""]).lower()
        points = _letters_of(joined)
        if not len(points):
            return np.zeros(0, np.int64), np.zeros((0, len(LANGS))), np.zeros(0, np.int64), np.zeros(0, np.int64)
        marks = self.marks[titles].take(points)
        kind = marks.astype(np.uint8)
        ends = kind & ALWAYS != 0
        before, after = np.roll(kind, 1), np.roll(kind, -1)
        before[0] = after[-1] = 0
        if titles:
            ends |= (kind & MAYBE != 0) & (before & SPACE != 0) & (after & SPACE != 0)
        else:
            twice = np.roll(kind, -2)
            twice[-2:] = 0
            ends |= (kind & MAYBE != 0) & ((after & SPACE != 0) | ((after & CLOSE != 0) & (twice & SPACE != 0)))
        letter = kind & LETTER != 0
        # letters, and one sign for all that stands between two words: what a segment begins and ends with, too
        kept = ~letter & np.r_[True, letter[:-1]]
        run = np.flatnonzero(kept)
        parts = np.zeros(len(run), bool)
        parts[np.searchsorted(run, np.flatnonzero(ends & ~letter), "right") - 1] = True
        texts_ended = np.bincount(np.searchsorted(run, np.flatnonzero(points == ord(TEXT_END)), "right") - 1, minlength=len(run))
        kept |= letter
        place = np.flatnonzero(kept)
        lead = int(letter[0])  # a sign before the first word
        sign = np.flatnonzero(~letter[place]) + lead
        char = np.full(len(place) + lead, self.marks[titles][ord(" ")], np.int32)
        char[lead:] = marks[place]
        char[sign] = self.marks[titles][ord(" ")]
        # signs where a segment ends and the next one begins, by their number
        parts[0] |= not lead
        cut = np.r_[np.zeros(lead, np.int64), np.flatnonzero(parts) + lead]
        cuts = np.r_[np.zeros(lead, np.int64), sign][cut]
        of = np.repeat(np.arange(0, 8 * len(cuts) - 8, 8), np.diff(cuts))
        of += char[cuts[0] : cuts[-1]] >> SCRIPT_AT & 7
        letters = np.bincount(of, minlength=8 * len(cuts) - 8).reshape(-1, 8).T
        some = np.diff(cuts) > 1
        low, high, n_words, letters = cuts[:-1][some], cuts[1:][some], np.diff(cut)[some], letters[:5, some]
        letters[0] = 0
        number = np.cumsum(np.r_[np.zeros(lead, np.int64), texts_ended])[cut[:-1]][some]
        main = letters.argmax(axis=0)
        far = 2.0 * letters.sum(axis=0)[:, None] + 1
        cost = np.repeat(far, len(LANGS), axis=1)
        latin = np.flatnonzero(main == 1)
        cost[latin, :8] = self.latin.phrases(char >> CODE_AT, low[latin], high[latin] + 1)
        cost[main == 2, LANGS.index("ru")] = 1
        cost[main == 3, LANGS.index("ko")] = 1
        for i in np.flatnonzero(main == 4).tolist():
            piece = place[low[i] + 1 - lead : high[i] - lead]
            text = points[piece[letter[piece]]].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            cost[i, 10:] = [a.phrases(text) for a in self.han]
        return number, cost * self.scale, letters[1] + letters[2] + 3 * (letters[3] + letters[4]), n_words

    @staticmethod
    def decide(cost: np.ndarray, letters: np.ndarray, words: np.ndarray, margin: float = MIN_MARGIN) -> tuple[np.ndarray, np.ndarray]:
        """Per segment the best language (-1 if it can't be told) and its confidence. One or two words are no sentence."""
        if not len(cost):
            return np.zeros(0, np.int64), np.zeros(0)
        best = cost.argmin(axis=1)
        low, second = np.partition(cost, 1, axis=1)[:, :2].T
        weight = np.exp2(-(cost - low[:, None]).clip(0, 60))
        sentence = (words >= 3) | ((letters >= 18) & (best >= LANGS.index("ja")))  # Chinese and Japanese don't part words
        sure = (letters >= MIN_LETTERS) & sentence & (second - low >= margin)
        return np.where(sure, best, -1), np.where(letters > 0, 1 / weight.sum(axis=1), 0.0)

    def label(self, texts: list[str], titles: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """(text number, language, confidence, letters) of each segment with a word, and the texts as they were parsed.

        A text with a segment that no language explains well (``STRANGE`` phrases a letter) may be garbled: it is
        repaired if so, and parsed again.
        """
        raw, texts = texts, list(texts)
        for k in np.flatnonzero(pc.match_substring_regex(pa.array(texts, pa.string()), MAY_BE_ODD)).tolist():
            texts[k] = _plain(texts[k])
        number, cost, letters, words = self.parse(texts, titles)
        best, confidence = self.decide(cost, letters, words)
        odd = np.unique(number[(cost.min(axis=1, initial=np.inf) > STRANGE * letters) | (best < 0)]) if len(cost) else []
        fixed = {int(k): _plain(back) for k in odd for back in [garble().restore(raw[k])[0]] if back != raw[k]}
        if fixed:
            keep = ~np.isin(number, list(fixed))
            n2, c2, l2, w2 = self.parse(list(fixed.values()), titles)
            number, cost = np.r_[number[keep], np.array(list(fixed), np.int64)[n2]], np.r_[cost[keep], c2]
            letters, words = np.r_[letters[keep], l2], np.r_[words[keep], w2]
            order = np.argsort(number, kind="stable")
            number, cost, letters, words = number[order], cost[order], letters[order], words[order]
            best, confidence = self.decide(cost, letters, words)
            for k, t in fixed.items():
                texts[k] = t
        self._whole(number, cost, letters, words, best, confidence)
        return number, best, confidence, letters, texts

    def _whole(self, number: np.ndarray, cost: np.ndarray, letters: np.ndarray, words: np.ndarray, best: np.ndarray, confidence: np.ndarray) -> None:
        """A text none of whose segments can be told by itself is decided as a whole; its longest segment takes the language."""
        told = np.unique(number[best >= 0])
        left = ~np.isin(number, told)
        if not left.any():
            return
        ids, at = np.unique(number[left], return_inverse=True)
        total = np.zeros((len(ids), len(LANGS)))
        np.add.at(total, at, cost[left])
        n_letters, n_words = np.bincount(at, letters[left]), np.bincount(at, words[left])
        lang, conf = self.decide(total, n_letters, n_words, WHOLE_MARGIN)
        rows = np.flatnonzero(left)
        for k in np.flatnonzero(lang >= 0):
            mine = rows[at == k]
            longest = mine[letters[mine].argmax()]
            best[longest], confidence[longest] = lang[k], conf[k]


def _plain(text: str) -> str:
    """Without invisible characters, odd forms and letters of another script that only look right; all would cut words."""
    if not text.isascii():
        if ODD_FORMS.search(text):
            text = unicodedata.normalize("NFKC", text).translate(INVISIBLE)
        if MIXED.search(text):
            text = forms().canonical(text)
    return text.replace(TEXT_END, " ") if TEXT_END in text else text


def _is_title(field: str) -> bool:
    return field.startswith("title")


def pieces(text: str, titles: bool) -> list[str]:
    """The segments with a word, as ``Model.parse`` counts them."""
    return [p.strip() for p in SPLIT[titles].split(text) if WORD.search(p.lower())]


def start_texts() -> dict[str, str]:
    return {k: " ".join(WORD.findall(START[k])) for k in LANGS}


def learn_texts(rows: list[tuple[str | None, str | None, str]]) -> dict[str, str]:
    """Running text of each language from (label, text, field) rows: the segments whose label can be trusted, in the order
    of the rows and each once, before the start.

    At first a label is trusted unless the start clearly contradicts it (by more than ``DOUBT`` phrases). Then either half
    of the rows is judged by what the other half has taught, so that no wrong label speaks for itself; twice over.
    """
    sample: dict[bool, list[tuple[int, str, int]]] = {True: [], False: []}
    for row, (label, text, field) in enumerate(rows):
        lang = canonical_label(label)
        if lang and text and not garble().is_garbled(text):
            sample[_is_title(field)].append((LANGS.index(lang), _plain(text), row))
    segments = {t: [(k, p) for k, (_, text, _) in enumerate(labelled) for p in pieces(text, t)] for t, labelled in sample.items()}
    # the half and the labelled language of each segment
    parsed = {t: (np.array([labelled[k][2] // 2 % 2 for k, _ in segments[t]], np.int64), np.array([labelled[k][0] for k, _ in segments[t]], np.int64)) for t, labelled in sample.items()}

    def told(judge: Callable[[Model, bool], np.ndarray], models: list[Model]) -> list[dict[str, str]]:
        """Texts of the halves and of both: the segments that the models of the halves trust."""
        parts: list[dict[str, dict[str, int]]] = [{k: {} for k in LANGS} for _ in range(3)]
        for t, labelled in sample.items():
            half, lang = parsed[t]
            trusted = np.zeros(len(half), bool)
            for h in range(2):
                trusted |= (half == h) & judge(models[h], t)
            for i in np.flatnonzero(trusted).tolist():
                k, piece = segments[t][i]
                words = " ".join(WORD.findall(piece.lower()))
                for where in (parts[half[i]], parts[2]):
                    where[LANGS[lang[i]]].setdefault(words, labelled[k][2])
        start, out = start_texts(), []
        for part in parts:
            running = {k: " ".join([*sorted(part[k], key=part[k].get), start[k]]) for k in LANGS}
            out.append({k: r if len(r) <= TEXT_CHARS else r[:TEXT_CHARS].rpartition(" ")[0] for k, r in running.items()})
        return out

    def cost_of(model: Model, t: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        _, cost, letters, words = model.parse([text for _, text, _ in sample[t]], t)
        return cost, letters, words

    def at_first(model: Model, t: bool) -> np.ndarray:
        cost, _, words = cost_of(model, t)
        return (words > 0) & (cost[np.arange(len(cost)), parsed[t][1]] <= cost.min(axis=1, initial=np.inf) + DOUBT)

    def later(model: Model, t: bool) -> np.ndarray:
        best, confidence = model.decide(*cost_of(model, t))
        return (best == parsed[t][1]) & (confidence > 0.9)

    texts = told(at_first, [Model(start_texts())] * 2)
    for _ in range(2):
        texts = told(later, [Model(texts[1]), Model(texts[0])])
    return texts[2]


def fit(df: DataFrame, label_col: str, fields: list[str], rows: int = SAMPLE_ROWS) -> dict[str, str]:
    """Texts learned from a bounded sample of labelled rows: the ``rows`` rows of the lowest hash of their content, so the
    same rows whatever their order; only as much of their text as a language's ``TEXT_CHARS`` goes to the driver."""
    place = F.xxhash64(F.lit("fit"), label_col, *fields)
    known = F.lower(F.regexp_extract(F.trim(F.col(label_col)), r"^[^-_]+", 0)).isin(list(CANONICAL))
    some = [F.substring(f, 1, TEXT_CHARS).alias(f) for f in fields]
    labelled = df.where(known)
    total = labelled.count()
    placed = labelled.withColumn("__place", place)
    lowest = lambda rows_: rows_.select(label_col, *some, "__place").orderBy("__place", label_col, *fields).limit(rows).collect()
    # the rows of the lowest hash are sought below a bound that half as many again should pass, so that hardly any is sorted
    bound = min((1 << 63) - 1, -(1 << 63) + int(min(1.0, 1.5 * rows / max(1, total)) * (1 << 64)))
    sample = lowest(placed.where(F.col("__place") <= bound))
    if len(sample) < min(rows, total):
        sample = lowest(placed)
    return learn_texts([(r[label_col], r[f], f) for r in sample for f in fields])


_models: dict[str, Model] = {}


def _model(key: str, words: dict[str, str]) -> Model:
    if key not in _models:
        _models.clear()
        _models[key] = Model(words)
    return _models[key]


def label_segments(df: DataFrame, id_col: str, fields: list[str], words: dict[str, str], *extra: str) -> DataFrame:
    """``work_id, <extra>, field_name, segments``: the segments of each text with language and confidence; no shuffle.

    ``segments`` is an array of (seg_no, lang, confidence, letters, segment); lang is null where it can't be told.
    """
    import uuid

    rows = as_fields(df, id_col, fields, *extra)
    key = uuid.uuid4().hex
    sent = df.sparkSession.sparkContext.broadcast(words)
    seg = T.StructType([T.StructField("seg_no", T.IntegerType()), T.StructField("lang", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("letters", T.IntegerType()), T.StructField("segment", T.StringType())])
    n = len(extra)
    schema = T.StructType([*rows.schema.fields[: 2 + n], T.StructField("segments", T.ArrayType(seg))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(key, sent.value)
        for whole in batches:
            for b, titles in _by_kind(whole, 1 + n):
                number, best, confidence, letters, texts = model.label(b.column(2 + n).to_pylist(), titles)
                flat = [p for t in texts for p in pieces(t, titles)]
                counts = np.bincount(number, minlength=b.num_rows)
                offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
                seg_no = (np.arange(len(flat)) - np.repeat(offsets[:-1], counts)).astype(np.int32)
                lang = pa.DictionaryArray.from_arrays(pa.array(np.where(best < 0, 0, best), pa.int32(), mask=best < 0), pa.array(LANGS)).cast(pa.string())
                struct = pa.StructArray.from_arrays([pa.array(seg_no), lang, pa.array(confidence, pa.float64()), pa.array(letters.astype(np.int32)), pa.array(flat, pa.string())], names=[f.name for f in seg])
                yield pa.RecordBatch.from_arrays([*b.columns[: 2 + n], pa.ListArray.from_arrays(pa.array(offsets), struct)], names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)


def _by_kind(batch: pa.RecordBatch, field_at: int) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """A batch as its titles and its other texts, in parts of bounded size."""
    title = np.array([_is_title(f) for f in batch.column(field_at).to_pylist()], bool)
    for kind in (True, False):
        at = np.flatnonzero(title == kind)
        for k in range(0, len(at), PART_ROWS):
            yield batch.take(pa.array(at[k : k + PART_ROWS])), kind


def mislabelled(df: DataFrame, id_col: str, fields: list[str], label_col: str, words: dict[str, str], min_chars: int = 25) -> DataFrame:
    """``work_id, field_name, langs`` of the fields whose languages aren't exactly the one that the label names.

    The comparison is made in the worker, so only the cases come back to the JVM.
    """
    import uuid

    rows = as_fields(df, id_col, fields, label_col).where(F.length("value") >= min_chars)
    key = uuid.uuid4().hex
    sent = df.sparkSession.sparkContext.broadcast(words)
    schema = T.StructType([rows.schema["work_id"], rows.schema["field_name"], T.StructField("langs", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(key, sent.value)
        bit: dict[str | None, int] = {}
        for whole in batches:
            for b, titles in _by_kind(whole, 2):
                number, best, _, _, _ = model.label(b.column(3).to_pylist(), titles)
                sets = np.zeros(b.num_rows, np.int64)
                np.bitwise_or.at(sets, number[best >= 0], 1 << best[best >= 0])
                labels = b.column(1).to_pylist()
                for label in set(labels) - bit.keys():
                    lang = canonical_label(label)
                    bit[label] = 1 << LANGS.index(lang) if lang else 0
                named = np.array([bit[label] for label in labels], np.int64)
                at = np.flatnonzero((sets > 0) & (sets != named))
                found = [[k for i, k in enumerate(LANGS) if sets[a] >> i & 1] for a in at]
                kept = b.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(2), pa.array(found, pa.list_(pa.string()))], names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)
