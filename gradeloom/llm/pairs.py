"""Defects of prompt and response pairs."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.labels import language_code
from gradeloom.llm.words import words
from gradeloom.session import cut, spread_join

#: Bound of the labelled prompts per language that the language model is fitted on.
LANGUAGE_ROWS = 1_500
#: Responses that hold a word for it to be known, and responses per one more; responses per end that is told apart.
COMMON, PER_COMMON, PER_END = 5, 200_000, 500_000
#: Turns of one prompt beyond which they are spread over several tasks.
HOT_TURNS = 5_000
#: Different words or ends that a task counts before it hands them on.
HELD = 500_000
#: Character n-grams are counted in so many hashed cells; their longest n.
CELLS, LONGEST = 1 << 16, 3
#: Letters that a response needs to be held against a language, and the log-odds per text that decide.
LEAST_LETTERS, LOG_ODDS = 24, 6.0
#: A text whose end has a lower likelihood of being an end is broken off.
END_LIKELIHOOD = 0.02


class Languages:
    """Naive Bayes over hashed character n-grams (n = 1 to LONGEST) of lower-case text, digits and signs left out."""

    def __init__(self, labelled: list[tuple[str, str]]):
        self.names = sorted({lang for lang, _ in labelled})
        counts = np.ones((max(1, len(self.names)), CELLS))
        for lang in self.names:
            codes, _ = self._codes([t for x, t in labelled if x == lang])
            if len(codes):
                counts[self.names.index(lang)] += np.bincount(codes, minlength=CELLS)
        self.table = np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32)

    @staticmethod
    def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cells of all n-grams of all texts, and the number of the text of each."""
        texts = [t.lower() if t.isascii() else unicodedata.normalize("NFKC", t).lower() for t in texts]
        joined = "\x00\x00\x00".join(texts)
        c = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        ends = np.cumsum([len(t) + 3 for t in texts])
        letter = (c > 64) & ((c < 0x2000) | (c > 0x2E7F)) & ~((c > 90) & (c < 97)) & ~((c > 122) & (c < 192))
        c = np.where(letter, c, np.where(c == 0, 0, 32))
        grams, where = [], []
        h = np.zeros(len(c), np.int64)
        ok = c > 0
        for n in range(1, LONGEST + 1):
            m = len(c) - n + 1
            if m <= 0:
                break
            h = h[:m] * 1_000_003 + c[n - 1 :]
            ok = ok[:m] & (c[n - 1 :] > 0)
            at = np.flatnonzero(ok & ((n == 1) & (c[:m] != 32) | (n > 1)))
            grams.append(((h[at] * 0x9E3779B97F4A7C1 >> 20) + n * 7919) % CELLS)
            where.append(at)
        if not grams:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.concatenate(where)
        return np.concatenate(grams), np.searchsorted(ends, at, side="right")

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log-likelihood per text and language."""
        out = np.zeros((len(texts), len(self.names)))
        codes, of = self._codes(texts)
        if len(codes):
            got = self.table[codes]
            for k in range(len(self.names)):
                out[:, k] = np.bincount(of, got[:, k], len(texts))
        return out


#: How a prompt names the language that it wants, to the code.
_ASKED = {
    "en": r"in english|auf englisch|en anglais|en inglés|на английском|(?:用|以)?英(?:语|文)",
    "de": r"in german|auf deutsch|en allemand|en alemán|на немецком|(?:用|以)?德(?:语|文)",
    "fr": r"in french|auf französisch|en français|en francés|на французском|(?:用|以)?法(?:语|文)",
    "es": r"in spanish|auf spanisch|en espagnol|en español|на испанском|西班牙(?:语|文)",
    "ru": r"in russian|auf russisch|en russe|en ruso|на русском|по-русски|俄(?:语|文)",
    "zh": r"in chinese|in mandarin|auf chinesisch|en chinois|en chino|на китайском|(?:用|以)?(?:中文|汉语)",
}
_ASKED_RE = {k: re.compile(v, re.I) for k, v in _ASKED.items()}

_MARKUP = re.compile(r"<[^<>\n]{0,80}>|&nbsp;|&#160;|&\w{2,8};")
_FENCES = re.compile(r"```\w*|~~~\w*")
_VISIBLE = re.compile(r"[^\W_]")
_EMPTY_JSON = re.compile(r'^\s*(?:\{\s*\}|\[\s*\]|null|none|""|\'\'|n/?a)\s*$', re.I)


def is_empty(text: str | None) -> bool:
    """Null, or nothing but blanks, invisible characters, punctuation or empty markup."""
    if text is None:
        return True
    return not _VISIBLE.search(_FENCES.sub("", _MARKUP.sub(" ", text))) or bool(_EMPTY_JSON.match(text)) and not text.strip().lower().startswith("n")


#: First-person refusals by language. Each alternative says that the writer will not or may not answer.
_REFUSAL = re.compile(
    r"(?ix)"
    r"\b(?:i|we)(?:\ (?:really|simply|must|have\ to|also|therefore|respectfully|politely))*\ (?:decline|refuse)\b|\b(?:i|we)\ (?:must|have\ to|need\ to|will\ have\ to|am\ going\ to|would\ like\ to)\ (?:respectfully\ |politely\ )?(?:decline|refuse|pass|abstain)\b"
    r"|\b(?:i|we)(?:'m|\ am|'re|\ are)\ (?:not\ (?:able|allowed|permitted|comfortable|willing|in\ a\ position|going)|unable)\ (?:to\ )?(?:help|assist|comply|answer|respond|provide|discuss|do|continue|support|fulfil+|share|engage|complete|take\ part|offer|with\ (?:that|this|answering|helping))"
    r"|\b(?:i|we)\ (?:can't|cannot|can\ not|can’t|won't|won’t|will\ not|may\ not|could\ not|couldn't)\ (?:really\ |in\ good\ conscience\ |be\ able\ to\ )?(?:help|assist|comply|fulfil+|do\ (?:that|this)|discuss|engage|support|take\ part|participate|answer\ (?:that|this|it|such|your)|respond\ to|be\ (?:answering|helping|able)|provide\ (?:an?\ )?(?:answer|response|help|assistance|that|this|such|information|advice)|give\ (?:you\ )?(?:an\ answer|that|this|advice)|continue\ with|share|offer\ (?:help|advice|an\ answer)|go\ (?:along|into)|talk\ about|work\ on|complete\ this)"
    r"|\bnot\ something\ (?:that\ )?(?:i|we)(?:'m|\ am|'re|\ are|\ can|\ will|\ could)\b|\bi(?:'d|\ would|’d)\ (?:rather|prefer)\ not\b|\b(?:i|we)(?:'d|\ would)\ rather\ not\b|\ba\ (?:topic|subject|matter)\ (?:that\ )?(?:i|we)\ (?:have|need|prefer|want)\ to\ (?:stay\ away|avoid|keep)|\bagainst\ (?:my|our|the)\ (?:guidelines|policy|policies|rules|principles|programming)|\binappropriate\ for\ (?:me|us)\b|\bas\ an\ (?:ai|language\ model|assistant),?\ i\ (?:can|am|do|must|will)|\boutside\ (?:of\ )?(?:my|what\ i)\b.{0,30}\b(?:scope|able|can|guidelines)|\bi\ have\ to\ (?:turn\ (?:this|that|it)\ down|say\ no)\b|\bi\ (?:do\ not|don't)\ (?:feel\ comfortable|want\ to\ (?:answer|help))|\b(?:i'm|i\ am)\ not\ going\ to\ (?:answer|help|do)|\bmy\ (?:guidelines|policy|rules)\ (?:do\ not|don't|forbid|prevent|prohibit)"
    r"|\b(?:ich|wir)\ (?:muss|müssen|möchte|werde|darf|kann|können|dürfen|will)\b.{0,50}\b(?:ablehnen|verweigern|nicht\ (?:helfen|weiterhelfen|beantworten|antworten|unterstützen|nachkommen|mitwirken|teilnehmen|eingehen|erfüllen|bearbeiten|äußern|behilflich))|\b(?:kann|darf|möchte|werde|muss|können|dürfen|müssen)\ (?:ich|wir)\b.{0,50}(?:\bablehnen|\bverweigern|\bnicht\ (?:\w+\ ){0,2}(?:helfen|weiterhelfen|beantworten|antworten|unterstützen|nachkommen|mitwirken|erfüllen|bearbeiten|äußern|eingehen|mitmachen|teilnehmen|behilflich))|\b(?:ist|wäre)\ (?:es\ )?(?:mir|uns)\ (?:leider\ )?nicht\ (?:möglich|erlaubt|gestattet)|\b(?:mir|uns)\ (?:ist|wäre)\ (?:es\ |das\ )?(?:leider\ )?nicht\ (?:möglich|erlaubt|gestattet)|\bverst(?:ößt|ieße)\ gegen\ meine|\bgegen\ meine\ (?:richtlinien|regeln|vorgaben)"
    r"|\bje\ (?:dois|me\ dois\ de|me\ vois\ (?:contraint|obligé)e?\ de|suis\ (?:contraint|obligé)e?\ de|préfère)\ (?:refuser|décliner|m'abstenir|ne\ pas)|\bje\ (?:ne\ (?:peux|puis|saurais|pourrai|souhaite|veux|suis)|n'ai)\b.{0,15}?(?:\bpas\b|\s)\s*(?:vous\ |en\ mesure\ |le\ droit\ |autorisé|à\ )?.{0,20}(?:aider|répondre|donner\ suite|fournir|traiter|participer|satisfaire|accéder|aborder|en\ mesure|autorisé|discuter)|\bje\ refuse\b|\bje\ décline\b|\bil\ m'est\ (?:impossible|interdit)\ de|\bcontraire\ à\ mes\ (?:règles|directives|consignes|principes)|\bne\ m'est\ pas\ (?:permis|possible)"
    r"|\bno\ (?:puedo|podemos|voy\ a|me\ es\ posible|me\ está\ permitido|estoy\ (?:en\ condiciones\ de|autorizad[oa]\ (?:a|para)|capacitad[oa]\ para))\ .{0,20}(?:ayud|respond|contest|asist|atender|cumplir|complacer|proporcionar|realizar|participar|hablar|tratar|dar\ una\ respuesta|ofrecer)|\b(?:debo|tengo\ que|me\ veo\ obligad[oa]\ a|prefiero)\ (?:rechazar|declinar|negarme|no\ )|\bme\ niego\b|\brechazo\ (?:esta|responder|la)|\bva\ en\ contra\ de\ mis|\bcontra\ mis\ (?:normas|directrices|reglas|principios)|\bme\ es\ imposible\ (?:ayud|respond|atender)"
    r"|(?:\bя\ (?:вынужден\w*|должен|должна|хочу|предпочту|предпочитаю|лучше)\b.{0,20}(?:отказ|воздерж|отклон|не\ отвечать))|\b(?:я|мы)\ (?:не\ (?:могу|можем|буду|имею\ права|стану|в\ состоянии|готов\w*|вправе))\b.{0,30}(?:помо|ответ|отвеч|выполн|обсужд|предостав|продолж|участв|дать|поддерж)|\bне\ (?:могу|смогу|буду|стану)\ (?:вам\ |с\ этим\ |на\ это\ |тут\ |здесь\ )*(?:помочь|ответить|отвечать|помогать|выполнить|обсуждать|участвовать)|\bмне\ (?:нельзя|не\ разрешено|запрещено|не\ положено|не\ позволено)\b|\b(?:отказываюсь|вынужден\w*\ отказать)|противоречит\ моим|против\ моих\ правил|не\ вправе\ (?:отвечать|помогать|обсуждать)"
    r"|我(?:们)?(?:只能|不得不|必须|需要|选择|要|会)?(?:拒绝|谢绝)|我(?:们)?(?:恐怕)?(?:不能|无法|不可以|不便|不会|没办法|没法|不愿|不应该|不允许|不被允许)(?:\w{0,8})?(?:回答|帮助|帮忙|帮到|协助|提供|满足|处理|完成|参与|讨论|答复|回应|继续|做到|答应)|(?:这个|此|该|您的|你的)?(?:任务|请求|问题|要求)我(?:只能|不得不|必须)?(?:拒绝|不能|无法)|(?:违反|不符合)我的?(?:准则|规定|原则|规则)|恕(?:我)?(?:难|不能|无法)|(?:抱歉|对不起|很遗憾)[，,]?.{0,12}(?:不能|无法|拒绝|不便|没法)"
)
#: Openings after which the rest answers nothing either.
_AFTER = re.compile(r"(?i)^\W*(?:is there anything else|i hope you understand|please (?:consult|contact|ask|try|let me)|thank you|sorry|as it may|if you|let me know|feel free|bitte|ich hoffe|ich bitte|gibt es|kann ich|vielen dank|veuillez|j'espère|y a-t-il|n'hésitez|merci|consultez|consulte|espero|hay algo|por favor|gracias|пожалуйста|надеюсь|могу ли|обратитесь|спасибо|请|希望|如果|您还|还有|感谢)")
_SENTENCE = re.compile(r"(?<=[.!?。！？])\s*(?=\S)|\n+")
#: Literals of which every refusal holds one; they only save time.
_REFUSAL_SIGNS = (
    "declin", "refus", "unable", "not able", "not allowed", "not permitted", "not comfortable", "not willing", "not in a position", "not going", "can't", "cannot", "can not", "can’t", "won't", "won’t", "will not", "may not", "could not", "couldn't", "not something", "rather not", "prefer not", "to pass", "abstain", "topic", "subject", "matter", "against", "inappropriate", "as an ai", "language model", "an assistant", "outside", "to turn", "say no", "do not", "don't", "guidelines", "policy", "rules",
    "ablehnen", "verweigern", "nicht", "gegen meine", "m'abstenir", "préfère", "ne peux", "ne puis", "ne saurais", "ne pourrai", "ne souhaite", "ne veux", "ne suis", "n'ai", "ne pas", "déclin", "m'est", "contraire à", "no puedo", "no podemos", "no voy", "no me ", "no estoy", "rechaz", "negarme", "prefiero", "debo", "tengo que", "obligad", "niego", "contra", "imposible",
    "отказ", "отклон", "воздерж", "не ", "нельзя", "запрещ", "противореч", "против моих", "拒绝", "谢绝", "不", "无法", "没", "违反", "恕",
)
#: Words of other content (ideographs count half) beside a refusal that are too few to be held against the prompt.
REFUSAL_REST = 14
#: A refusing sentence with more words than this is weighed clause by clause.
LONG_SENTENCE = 40
_CLAUSE = re.compile(r"[,;:，、；：]\s*|\s[-–—]\s|—")
_BUT = re.compile(r"(?i)\b(?:but|however|aber|jedoch|mais|cependant|pero|но|однако)\b|但是?|不过|然而")
_LIST_MARK = re.compile(r"(?m)^\s*(?:\d{1,2}[.)]|[-*•+])(?:\s+|$)")
#: An answer that is marked as one.
_MARKED = re.compile(r"(?im)\\boxed\b|^\W*(?:(?:final )?answer|result|solution|antwort|ergebnis|lösung|réponse|résultat|respuesta|resultado|ответ|результат|答案|结果)\W{0,3}[:：]\W*\w")
#: Longer words that questions and refusals share whatever they are about.
_COMMON = frozenset("about after answer answers asked because before being below briefly could every final first following given instead letter other others option people please question questions reply request respond response should single their there these thing things think those topic under using where which while whole without would write".split())


def weight(ws: list[str]) -> float:
    """Number of words, ideographs counting half."""
    return sum(0.5 if w >= "一" else 1 for w in ws)


def _content(ws: list[str]) -> set[str]:
    """Words that tell what a text is about; of ideographs, pairs."""
    return {w for w in ws if len(w) > 4 and w not in _COMMON} | {a + b for a, b in zip(ws, ws[1:]) if a >= "一" and b >= "一"}


def _answers(rest: list[str], asked: list[str]) -> bool:
    """Whether sentences beside a refusal answer the prompt: a marked answer, a number that the prompt hasn't, or, if
    they are long enough, much of what the prompt is about."""
    if any(_MARKED.search(s) for s in rest):
        return True
    parts = [words(_LIST_MARK.sub("", s)) for s in rest]
    known = set(asked)
    if any(w[0].isdigit() and w not in known for ws in parts for w in ws):
        return True
    if sum(map(weight, parts)) <= REFUSAL_REST:
        return False
    about = _content(asked)
    shared = about & set().union(*map(_content, parts))
    return len(shared) >= min(8, max(3, 0.4 * len(about)))


def is_refusal(text: str, asked: list[str] | tuple[str, ...] = ()) -> bool:
    """Declines in the first person and answers nothing beside that, whatever its length; asked: words of the prompt.
    Reports of others' refusals or of impossible things don't count, nor does what is only quoted."""
    low = text.lower()
    if not any(x in low for x in _REFUSAL_SIGNS) or not _REFUSAL.search(text):
        return False
    rest = []
    found = False
    for s in _SENTENCE.split(own_words(text)):
        m = _REFUSAL.search(s)
        if m:
            found = True
            if but := _BUT.search(s, m.end()):
                rest.append(s[but.end() :])
            elif weight(words(s)) > LONG_SENTENCE:
                rest += [c for c in _CLAUSE.split(s) if c and not _REFUSAL.search(c)]
        elif not _AFTER.match(s):
            rest.append(s)
    return found and "```" not in text and not _answers(rest, list(asked))


def is_copy(text: str, asked: list[str]) -> bool:
    """Repeats the words of the last user message, perhaps in part or restyled, and adds no answer after them."""
    r = words(text)
    if len(r) < 4 or len(asked) < 4 or len(r) > 1.3 * len(asked) + 6:
        return False
    known = set(asked)
    if sum(w in known for w in r) < 0.85 * len(r):
        return False
    cp = Counter(asked)
    shared = (Counter(r) & cp).total()
    if shared < 0.85 * len(r) or shared < 0.6 * len(asked):
        return False
    # what follows the last run of two words of the message is an answer
    pairs = set(zip(asked, asked[1:]))
    last = max((i for i in range(len(r) - 1) if (r[i], r[i + 1]) in pairs), default=-1)
    if last < 0:
        return False
    return last + 2 >= len(r) or len(r) - last - 2 <= 1 and r[-1] in cp


_QUOTE = re.compile(r"\"[^\"\n]{12,}\"|“[^”\n]{12,}”|„[^“”\n]{12,}[“”]|«[^»\n]{12,}»|「[^」\n]{6,}」|```.*?(?:```|\Z)|`[^`\n]+`", re.S)


def own_words(text: str) -> str:
    """Text without quotations and code, or all of it if hardly anything is left."""
    rest = _QUOTE.sub(" ", text)
    return rest if len(rest) >= 0.25 * len(text) else text


_SHAPES = re.compile(r"\n|```|\d+(?:[.,]\d+)*|[一-鿿]|[^\W\d_一-鿿]+|[^\w\s]|_")


_ASCII_SHAPES = re.compile(r"\n|```|\d+(?:[.,]\d+)*|[A-Za-z]+|[^\w\s]|_")
#: Signs of which one closes a sentence; their ends are never asked for.
_CLOSERS = frozenset(".!?。！？…")


def shapes(text: str) -> list[str]:
    return (_ASCII_SHAPES if text.isascii() else _SHAPES).findall(text)


def last_shapes(body: str) -> list[str]:
    """At least the last four shapes of a text, or all."""
    got = shapes(body[-240:])
    return got[1:] if len(got) > 4 else got if len(body) <= 240 else shapes(body)


_ITEM = re.compile(r"\s*[-*•+]\s")
#: An end that closes a sentence, and a list number that nothing follows.
_CLOSED_END = re.compile(r"[.!?。！？…][\"'”’»」)*_`]*$")
_BARE_NUMBER = re.compile(r"\n\s*\d{1,2}[.)]$")
#: A last line of one or two words, no list item, after a line that closes with a stop or colon. Ideographs aren't words here.
_LAST_LINE = re.compile(r"(?s)^.*[.!?。！？:：][\"'”’»」)*_`]*\s*\n+(?!\s*(?:[-*•+]|\d{1,2}[.)])\s)[^\w\n]{0,3}((?:-?\d+(?:[.,/]\d+)?|[^\W\d_一-鿿][^\W_一-鿿]*)(?: [^\W_一-鿿]+)?)[^\w\n]{0,3}$")
_NUMBER = re.compile(r"-?\d+(?:[.,/]\d+)?(?: [^\W\d_]{4,})?")
#: Answers of one word.
_VERDICTS = frozenset("yes no true false none ja nein wahr falsch oui non vrai faux sí no verdadero falso да нет верно неверно".split())
#: A prompt that wants one word, letter, name or number for an answer, or a short one.
_BRIEF = re.compile(r"(?i)\b(?:one|single|a) (?:word|letter|name|number)\b|\bthe (?:letter|name|word|label)\b.{0,40}\bonly\b|\bas briefly\b|\bein(?:em|en)? (?:einzigen? )?(?:wort|buchstaben?|zahl)\b|\bun seul mot\b|\bune seule lettre\b|\b(?:una sola|una) (?:palabra|letra)\b|\bодн(?:им|ой|о|у) (?:словом|слово|буквой|букву)\b|一个(?:词|字母|数字)")


def answer_line(body: str, known: set[str], asked: str = "") -> bool:
    """The last line holds nothing but an answer: a number, a letter, a verdict, a name (capital words that are not known
    in lower case), or the one word that the prompt wants."""
    m = _LAST_LINE.match(body)
    if not m:
        return False
    line = m.group(1)
    ws = line.split(" ")
    if _NUMBER.fullmatch(line) or len(ws) == 1 and (len(line) == 1 and line.isupper() or line.lower() in _VERDICTS):
        return True
    if all(w[0].isupper() and w.lower() not in known for w in ws):
        return True
    return len(ws) == 1 and line not in known and bool(_BRIEF.search(asked))


class Endings:
    """Likelihood that a text ends after its last tokens: counts of token n-grams (n = 1..3) that were ends against all
    of their places, with back-off. Tokens are words, signs, line breaks; names and numbers count by shape. The counts
    come in three steps, each over batches of texts: words, ends that close no sentence, and the places of these ends."""

    def __init__(self, texts: list[str] = (), weight: float = 4.0):
        self.weight = weight
        self.known: frozenset[str] = frozenset()
        self.end: dict[tuple[str, ...], int] = {}
        self.all: dict[tuple[str, ...], int] = {}
        self.base = 1.0
        self.learn(self.words_of(texts), COMMON)
        self.ask(self.ends_of(texts), 1)
        self.place(self.places_of(texts), len([x for x in texts if x]))

    @staticmethod
    def words_of(texts: list[str]) -> Counter:
        """Numbers of texts per word."""
        seen: Counter = Counter()
        for x in texts:
            # the last token does not count: a text that is broken off may end in a part of a word
            seen.update(set(shapes(x)[:-1]))
        return Counter({t: n for t, n in seen.items() if t[0].isalpha() and t == t.lower()})

    def learn(self, seen: dict[str, int], least: int) -> None:
        self.known = frozenset(t for t, n in seen.items() if n >= least)

    def ends_of(self, texts: list[str]) -> Counter:
        found: Counter = Counter()
        for x in texts:
            body = x.rstrip()
            if body and body[-1] not in _CLOSERS:
                t = self.tokens(body)
                if len(t) > 2:
                    found.update(tuple(t[-n:]) for n in (1, 2, 3))
        return found

    def ask(self, ends: dict[tuple[str, ...], int], least: int) -> None:
        self.end = {k: n for k, n in ends.items() if n >= least}
        self.ids = {t: i for i, t in enumerate(sorted({t for k in self.end for t in k}), 1)}
        self.keys, self.codes = {}, {}
        for n in (1, 2, 3):
            coded = sorted((self._code(k), k) for k in self.end if len(k) == n)
            self.codes[n], self.keys[n] = np.array([c for c, _ in coded], np.int64), [k for _, k in coded]

    def _code(self, key: tuple[str, ...]) -> int:
        c = 0
        for t in key:
            c = c * (len(self.ids) + 1) + self.ids[t]
        return c

    def places_of(self, texts: list[str]) -> Counter:
        """Numbers of places per (n, number of the end), and of all tokens at (0, 0)."""
        start, ids, size = self.ids.get("^", 0), self.ids, len(self.ids) + 1
        row: list[int] = []
        total = 0
        memo: dict[str, int] = {}
        for x in texts:
            body = shapes(x.rstrip())
            if not body:
                continue
            total += len(body) + 2
            row += (0, 0, start, start)  # no n-gram reaches over the zeros
            for t in body:
                i = memo.get(t)
                if i is None:
                    i = memo[t] = ids.get(self._shape(t), 0)
                row.append(i)
        at = np.array(row, np.int64)
        found = Counter({(0, 0): total})
        code, ok = at, at > 0
        for n in (1, 2, 3):
            if n > 1:
                ok = ok[: len(at) - n + 1] & (at[n - 1 :] > 0)
                code = code[: len(at) - n + 1] * size + at[n - 1 :]
            asked = self.codes[n]
            if not len(asked) or not len(code):
                continue
            c = code[ok]
            i = np.minimum(np.searchsorted(asked, c), len(asked) - 1)
            sums = np.bincount(i[asked[i] == c], minlength=len(asked))
            for k in np.flatnonzero(sums):
                found[n, int(k)] = int(sums[k])
        return found

    def place(self, places: dict[tuple[int, int], int], texts: int) -> None:
        self.all = {self.keys[n][k]: m for (n, k), m in places.items() if n}
        self.base = max(1, texts) / max(1, places.get((0, 0), 0))
        self.keys, self.codes, self.ids = {}, {}, {}

    def _shape(self, t: str) -> str:
        if t[0].isdigit():
            return "9"
        if t[0].isalpha() and t not in self.known:
            return "A" if t[0].isupper() else "?" if t < "一" else "字"
        return t

    def tokens(self, body: str) -> list[str]:
        """The last tokens of a text without blanks at its end."""
        return ["^", "^", *map(self._shape, last_shapes(body))]

    def likelihood(self, text: str) -> float:
        t = self.tokens(text.rstrip())
        p = self.base
        for n in (1, 2, 3):
            k = tuple(t[-n:])
            # one end less: the text itself is among those counted
            p = (max(0, self.end.get(k, 0) - 1) + self.weight * p) / (self.all.get(k, 0) + self.weight)
        return p

    def odd_word(self, text: str) -> bool:
        """The text, no list item, stops in a lower-case word that hardly occurs elsewhere: most likely a part of one."""
        body = text.rstrip()
        return self.tokens(body)[-1] == "?" and not _ITEM.match(body.rsplit("\n", 1)[-1])


_OPENERS = {"(": ")", "[": "]", "{": "}"}


def left_open(text: str) -> bool:
    """A code fence, or an object or list that the text starts with, is not closed."""
    if text.count("```") % 2:
        return True
    body = text.strip()
    if body[:1] not in "{[" or not body[:1]:
        return False
    stack, quoted, skip = [], False, False
    for ch in body:
        if skip:
            skip = False
        elif quoted:
            skip = ch == "\\"
            quoted = ch != '"'
        elif ch == '"':
            quoted = True
        elif ch in _OPENERS:
            stack.append(_OPENERS[ch])
        elif stack and ch == stack[-1]:
            stack.pop()
    return quoted or bool(stack)


def is_truncated(text: str, endings: Endings, asked: str = "") -> bool:
    body = text.rstrip()
    if left_open(body):
        return True
    if _BARE_NUMBER.search(body[-12:]):
        return True
    if _CLOSED_END.search(body[-12:]) or len(last_shapes(body)) < 4 or answer_line(body, endings.known, asked):
        return False
    return endings.odd_word(body) or endings.likelihood(body) < END_LIKELIHOOD


def _share(h, of: float):
    """Whether a hash column falls into the given share of its range."""
    return F.pmod(h, F.lit(1 << 30)) < F.lit(min(1.0, of) * (1 << 30))


def fit_languages(splits: DataFrame) -> Languages:
    """The language model, from about LANGUAGE_ROWS labelled prompts per language, drawn by hash: the labels are counted,
    then the share of each that gives this number is read, so that no task and no driver holds more."""
    text = F.expr("element_at(filter(messages, m -> m.role = 'user'), -1).content")
    code = language_code(F.col("language"))
    rows = splits.select(code.alias("lang"), F.xxhash64("id", "loaded_at").alias("h"), text.alias("t")).filter("lang <> 'unknown'")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Languages([])
    drawn = reduce(lambda x, y: x | y, [(F.col("lang") == lang) & _share(F.col("h"), LANGUAGE_ROWS / n) for lang, n in counts.items()])
    return Languages(sorted((r.lang, r.t) for r in rows.filter(drawn).filter("t is not null").limit(4 * LANGUAGE_ROWS * len(counts)).select("lang", "t").collect()))


def fit_endings(samples: DataFrame) -> Endings:
    """The model of ends over all responses of samples."""
    return count_endings(samples.select(F.explode("turns").alias("t")).select(F.col("t.response.text").alias("text")))


def count_endings(turns: DataFrame) -> Endings:
    """The model of ends, counted over all responses (column text): three passes that send counts only. What is held grows slower than
    the data, as words and ends have to be met more often where there are more responses (PER_COMMON, PER_END)."""
    texts = turns.select("text").filter("length(text) > 0")
    n = texts.count()
    model = Endings()

    def counted(count, schema: str):
        """Sums over all texts of what count(texts) gives, added up within each task first."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums: Counter = Counter()
            frame = lambda: pd.DataFrame([(*k, m) if isinstance(k, tuple) else (k, m) for k, m in sums.items()], columns=names)
            for pdf in batches:
                sums.update(count(pdf["text"].tolist()))
                if len(sums) > HELD:
                    yield frame()
                    sums.clear()
            yield frame()

        names = [x.split(" ")[0] for x in schema.split(", ")]
        return texts.mapInPandas(run, schema).groupBy(*names[:-1]).agg(F.sum("m").alias("m"))

    least = max(COMMON, n // PER_COMMON)
    model.learn({r.w: r.m for r in counted(model.words_of, "w string, m long").filter(F.col("m") >= least).collect()}, least)
    sent = turns.sparkSession.sparkContext.broadcast(model)
    least = max(1, n // PER_END)
    ends = counted(lambda x: Counter({"\x1f".join(k): m for k, m in sent.value.ends_of(x).items()}), "k string, m long")
    model.ask({tuple(r.k.split("\x1f")): r.m for r in ends.filter(F.col("m") >= least).collect()}, least)
    asked = turns.sparkSession.sparkContext.broadcast(model)
    model.place({(r.n, r.k): r.m for r in counted(lambda x: asked.value.places_of(x), "n int, k int, m long").collect()}, n)
    return model


def pair_defects(samples: DataFrame, splits: DataFrame) -> DataFrame:
    """`id`, `sample`, `turn`, `defect`: a row per turn with a response that is empty, a copy of the last user message,
    a refusal, in the wrong language, or truncated (checked in this order; a turn has one defect).

    Method: language posteriors of the prompt and the response from character n-gram naive Bayes; an end-of-text n-gram
    likelihood for truncation; the first is fitted on a bounded sample of labelled prompts (LANGUAGE_ROWS), the second on
    all responses. A response may be in the
    language of the prompt or in one that the prompt asks for; quotations and code are left out, and short answers are
    not judged. Where a turn has no prompt, the messages of the splits row and the user's turns so far stand in.

    Repeated deliveries count once; null turns, turns without response and null keys give no row; a turn whose prompt
    isn't known is judged without it; empty tables give no rows. The turns are written once, without what isn't needed; nothing
    but found rows is shuffled, except rows that lack a prompt: they are joined by id, an id with many rows being spread."""
    spark = samples.sparkSession
    user = "element_at(filter({0}, m -> m.role = 'user'), -1).content"
    turns = samples.filter("id is not null and sample is not null and turns is not null").select("id", "sample", F.posexplode("turns").alias("turn", "t")).filter("t is not null and t.response is not null")
    asked = F.expr(f"case when t.prompt is not null then {user.format('t.prompt')} end")
    turns = cut(turns.select("id", "sample", "turn", F.col("t.response.text").alias("text"), asked.alias("asked"), F.col("t.prompt").isNull().alias("lost")), "p4turns")
    sent = spark.sparkContext.broadcast((fit_languages(splits), count_endings(turns)))
    lost = turns.filter("lost").select("id", "sample", "turn", "text")
    prompts = splits.filter("id is not null").join(lost.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.max(F.struct("messages", "turns")).alias("x"))
    prompts = prompts.select("id", F.expr(user.format("x.messages")).alias("first"), F.expr("transform(x.turns, t -> t.message)").alias("later"))
    lost = spread_join(lost, prompts, "id", "sample", "left", HOT_TURNS).select("id", "sample", "turn", "text", F.expr("coalesce(get(later, turn), case when turn = 0 then first end)").alias("asked"))
    known = turns.filter("not lost").select("id", "sample", "turn", "text", "asked")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, ends = sent.value
        names = model.names
        of_prompt: dict[int, tuple[np.ndarray, list[str], frozenset[str]]] = {}

        def judge(part: pd.DataFrame) -> pd.DataFrame:
            out: list[str | None] = [None] * len(part)
            asked = [a if isinstance(a, str) else "" for a in part["asked"]]
            texts = [t if isinstance(t, str) else None for t in part["text"]]
            new = list(dict.fromkeys(a for a in asked if hash(a) not in of_prompt))
            if len(of_prompt) > 20_000:  # bounds a worker's memory only
                of_prompt.clear()
                new = list(dict.fromkeys(asked))
            for a, s in zip(new, model.scores(new) if new and names else np.zeros((len(new), 0))):
                of_prompt[hash(a)] = (s, words(a), frozenset(k for k, p in _ASKED_RE.items() if p.search(a)))
            check = []
            for i, (t, a) in enumerate(zip(texts, asked)):
                if is_empty(t):
                    out[i] = "empty"
                elif a and is_copy(t, of_prompt[hash(a)][1]):
                    out[i] = "copy"
                elif is_refusal(t, of_prompt[hash(a)][1]):
                    out[i] = "refusal"
                else:
                    check.append(i)
            own = [own_words(texts[i]) for i in check]
            scores = model.scores(own) if own and names else np.zeros((len(own), 0))
            for i, o, s in zip(check, own, scores):
                a = asked[i]
                if a and names and sum(map(str.isalpha, o)) >= (LEAST_LETTERS if o.isascii() else LEAST_LETTERS // 3):
                    ps, _, wanted = of_prompt[hash(a)]
                    best = int(np.argmax(s))
                    fine = {names[int(np.argmax(ps))], *wanted}
                    if names[best] not in fine:
                        rest = max(s[names.index(f)] for f in fine if f in names)
                        sure = np.sort(ps)[-1] - np.sort(ps)[-2] if len(ps) > 1 else 0
                        if s[best] - rest > LOG_ODDS and sure > LOG_ODDS:
                            out[i] = "wrong_language"
                            continue
                if is_truncated(texts[i], ends, asked[i]):
                    out[i] = "truncated"
            found = part[["id", "sample", "turn"]].assign(defect=out)
            return found[found["defect"].notna()]

        for pdf in batches:
            for a in range(0, len(pdf), 1_000):
                yield judge(pdf.iloc[a : a + 1_000])

    schema = "id string, sample int, turn int, defect string"
    return known.mapInPandas(run, schema).unionByName(lost.mapInPandas(run, schema)).distinct()
