"""Defective question/response pairs and their kinds of defect.

Method: ordered rules for emptiness, copied questions, multilingual refusals, script and language mismatch, unclosed
delimiters and abrupt endings. Every rule that holds is emitted; the first in this order names the pair's defect. The
rules read a pair once, in Arrow batches: as column expressions they took some twenty passes of regular expressions
over every text, and several times the CPU. Only the check for words cut in the middle compares with the whole corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.session import hot_split_join, materialize

ORDER = ("empty", "copy", "refusal", "wrong_language", "truncated")
EMPTY, COPY, REFUSAL, WRONG_LANGUAGE, TRUNCATED = (1 << i for i in range(len(ORDER)))

# Names of the fields, alone or before a repeated question.
LABELS = "q|a|do|question|answer|response|prompt|frage|antwort|pregunta|respuesta|réponse|domanda|risposta"
INTRO = LABELS.split("|") + "you asked your the was is it said repeat du hast gefragt deine tu vous avez demandé votre ta preguntaste has hai chiesto la".split()

# How a response declines, as regular expressions over lower-cased text with plain apostrophes.
REFUSALS = {
    "en": [
        r"\bi(?:'m| am) (?:really |very |so |deeply |afraid |truly )*(?:sorry|unable|not (?:able|allowed|permitted|authori[sz]ed|in a position|comfortable|going to)|afraid)",
        r"\bi (?:really |simply |just |also )*(?:can't|can ?not|could not|couldn't|won't|will not|must (?:decline|refuse|not)|(?:have|need) to (?:decline|refuse)|do(?: not|n't) (?:feel comfortable|have (?:the ability|permission)|wish to|want to)|would (?:rather|prefer) not|decline|refuse)\b",
        r"\bi'd (?:rather|prefer) not\b|\bi prefer not to\b",
        r"\bmy (?:guidelines|policy|policies|rules|instructions|programming|creators)\b.{0,30}\b(?:not|forbid|prohibit|prevent)",
        r"\b(?:not something|nothing) (?:that )?i (?:can|am)\b|\boutside (?:of )?what i\b|\bfor me to (?:respond|answer|reply|say|help|discuss|comment)\b",
        r"\b(?:this|your|the) (?:assistant|model|helper) (?:does not|doesn't|cannot|can't|will not|won't|is not (?:able|allowed))\b.{0,20}(?:answer|help|respond|reply|discuss)",
        r"\bas an? (?:ai|assistant|language model|ai model|helper)\b.{0,40}\b(?:can't|cannot|can not|unable|not|must)\b",
        r"^\W*(?:hello\W+|hi\W+|well\W+)?(?:sorry|apologies|unfortunately|regrettably|declined|no comment)\b",
        r"^\W*(?:the |this |your )?(?:request|question|query) (?:was |is |has been |must be )?(?:refused|denied|declined|rejected)\b",
        r"^\W*(?:hello\W+)?(?:no, )?(?:cannot|can't|can not|won't|unable to|not (?:permitted|allowed|able) to) (?:comply|do|help|assist|answer|run|execute|respond|reply)\b",
        r"\bi.{0,12}have no permission\b|\bhave no permission to\b",
    ],
    "de": [
        r"\btut mir (?:sehr )?leid\b|\bals (?:ki[- ])?assistent(?:in)?\b|\bich (?:bitte um entschuldigung|bedaure|lehne|weigere)\b",
        r"\b(?:kann|darf|möchte|werde|will|könnte) ich\b.{0,40}\b(?:nicht|nichts|keine[nr]?)\b|\bich (?:kann|darf|möchte|werde|will|muss)\b.{0,40}\b(?:nicht|nichts|keine[nr]?|ablehnen|verweigern)\b",
        r"\bist (?:es )?mir (?:leider )?nicht (?:erlaubt|möglich|gestattet)\b|\bbin (?:ich )?(?:leider )?nicht (?:befugt|berechtigt|in der lage)\b|\bmeine richtlinien\b",
    ],
    "es": [
        r"\blo siento\b|\blo lamento\b|\bcomo (?:asistente|modelo)\b|\b(?:debo|tengo que) (?:rechazar|negarme|declinar)\b|\bme niego\b|\bprefiero no\b|\bmis (?:normas|directrices|reglas)\b",
        r"\bno (?:puedo|podré|podría|debo|voy a|quiero)\b|\bno se me permite\b|\bno (?:me es posible|estoy autorizad|tengo permi|me está permitido|está permitido que)",
    ],
    "fr": [
        r"\bdésolée?\b|\ben tant qu'(?:assistant|ia)|\bje (?:dois|préfère|me dois de) (?:refuser|décliner|ne pas)\b|\bje (?:refuse|regrette)\b|\bmes (?:consignes|règles|directives)\b",
        r"\bje ne (?:peux|puis|suis|pourrai|veux|souhaite|dois|saurais)\b|\bil m'est (?:impossible|interdit)\b|\bje n'ai pas (?:le droit|la permission|la possibilité)",
    ],
    "it": [
        r"\bmi (?:dispiace|spiace|rifiuto|scuso)\b|\bcome assistente\b|\bdevo (?:rifiutare|declinare)\b|\bpreferisco non\b|\ble mie (?:regole|linee)\b",
        r"\bnon (?:posso|potrò|potrei|sono (?:autorizzat|in grado)|mi è (?:permesso|consentito|possibile)|ho il permesso|voglio)",
    ],
}
#: Words one of which every text has that any refusal above matches (a test walks through all alternatives); texts
#: without skip the long rules, whatever their length.
HINTS = frozenset(
    "i me my ai assistant assistents assistent assistentin assistente asistente model helper sorry apologies unfortunately regrettably comment refused denied declined rejected cannot can won "
    "unable not permission ich mir bin mi mie je mes mis voy siento lamento modelo debo tengo niego prefiero puedo podré podría podr quiero "
    "estoy se está richtlinien désolé désolée tant m devo preferisco posso potrò potrei potr sono ho voglio".split()
)

# Frequent words of each language that tell it from the others.
LANGUAGES = {
    "en": "a an as but both nothing except two because if or so than then one the of and to is are was were in on at by for with from this that these those it its your our my which what how does do can could where who why when should would tell about near any every each some no not only under over whenever until has have there help be keep run type use part after before another",
    "de": "der die das den dem des ein eine einen einem einer und ist nicht mit für auf von zu im am wie wo was warum wann ich bis jemand wird wurde danach ohne bei nach sich es auch sind hat kann muss man ob wenn dass mehr davon jedes sonst sollte seitdem bitte wieder mir erkläre lange finde zuerst alles",
    "es": "a ya más deja están el los las un una unos unas del y es está en que con para por cómo qué dónde cuándo cuánto se su después sin hay desde si al lo cada cuando luego todo sigue debería queda primero entonces favor muy también hasta alguien puede hace como de la no",
    "fr": "à bien le les un une des du et est dans qui avec pour par comment où quand pourquoi ce sa ses sans après au aux il elle n'est pas plus reste depuis devrait sinon combien puis est-ce que fait faut moi chacun ensuite tout jusqu'à quelqu'un dure y en de la ne sont être",
    "it": "a il lo gli i un uno una di del della dei e è in che con per dove quando quanto perché non si suo dopo senza al alla da ci sono più dentro come cosa fa poi tutto resta finché qualcuno così devo alle ogni solito basta trovo la le essere tra fra",
}

# Words with which no sentence of the language ends.
OPEN_ENDS = (
    "a an the and or but nor because although though unless until while whenever which whose whom that than of to from with without into onto upon at by for as if when where "
    "between beyond behind beside against across along around above below inside under near during is are was were be been has have had will would shall should can could may might must "
    "its their our your my his her some every each any another so "
    "der die das den dem des ein eine einen einem einer eines und oder aber sondern weil wenn dass ob mit für von zu im am bei als wie bis ohne durch über unter zwischen seit sich "
    "ist sind war wird wurde hat haben kann soll muss sehr ihre seine unser unsere "
    "el la los las un una unos unas de del y e o u pero si cuando que porque con para por en al sin sobre entre hasta desde como su sus muy está es son cada "
    "le les une des du et ou mais quand qui parce avec pour par dans à au aux sur sous sans chez comme est sont se ce cette son sa ses leur très ne d l qu chaque "
    "il lo gli i uno di della dei delle ma se che perché per in alla da dal dalla su sul tra fra è sono suo sua molto non ogni"
).split()


_REFUSAL = re.compile("|".join(x for group in REFUSALS.values() for x in group))
_LABEL = re.compile(rf"^\W*(?:{LABELS}) ?[:：]")
_INTRO = frozenset(INTRO)
_OPEN_ENDS = frozenset(OPEN_ENDS)
_WORD = re.compile(r"[^\W_]+")
_PLAIN = str.maketrans("’‘ʼ`´", "'''''")
_UNSEEN = re.compile("[\u200b-\u200f\u2060\ufeff\u00ad]+")
_QUOTED = re.compile(r"[„“\"«][^„“”\"«»]{0,80}[“”\"»]")
_FOREIGN = regex.compile(r"(?=\p{L})\P{Latin}")
_LATIN = regex.compile(r"(?=\p{L})\p{Latin}")
# endings
_OPEN_GERMAN, _GERMAN = re.compile("“[^”]*$"), re.compile("„[^“”]*“[^“”]*$")
_OPTION, _NUMBER, _BULLET = re.compile(r"\s--[A-Za-z0-9_]+$"), re.compile(r"(?:^|\s)\d+\)$"), re.compile(r"(?:^|\s)[*•]$")
_CLOSED = re.compile(r"[.!?。！？]['\"”’»“)\]]*$")
_TAIL = re.compile(r"([^\W_]+)(?:[\W_]{0,2})$")
_LAST = re.compile(r"(?:^|[\W_])([^\W\d_]+)$")

#: How many words of a set each language knows, as one number of 12 bits for each language.
_BITS = 12
_KNOWN: dict[str, int] = {}
for _i, _k in enumerate(LANGUAGES):
    for _w in set(LANGUAGES[_k].split()):
        _KNOWN[_w] = _KNOWN.get(_w, 0) + (1 << _BITS * _i)
_KEYS = frozenset(_KNOWN)


def normal(text: str) -> str:
    """Lower case, plain apostrophes, no invisible characters, white space of any kind as one blank."""
    t = text.lower()
    if not t.isascii():
        t = _UNSEEN.sub("", t.translate(_PLAIN))
    elif "`" in t:
        t = t.replace("`", "'")
    return " ".join(t.split())


def refuses(t: str, words: frozenset | set) -> bool:
    """Whether a normal text, of these words, declines."""
    return not HINTS.isdisjoint(words) and _REFUSAL.search(t) is not None


def _own_words(text: str, words: set) -> set:
    """The words without those of quoted terms. ``words`` are those of the whole text."""
    if '"' in text or (not text.isascii() and not {"„", "“", "«"}.isdisjoint(text)):
        return set(_WORD.findall(_QUOTED.sub(" ", text).lower()))
    return words


def _scores(words: set) -> list[int]:
    n = sum(_KNOWN[w] for w in words & _KEYS)
    return [n >> _BITS * i & ((1 << _BITS) - 1) for i in range(len(LANGUAGES))]


def other_language(q: str, r: str, q_words: set, r_words: set) -> bool:
    """Whether r is written in another script or another of the five languages than q."""
    if not (q.isascii() and r.isascii()):
        lq, nq, lr, nr = len(_LATIN.findall(q)), len(_FOREIGN.findall(q)), len(_LATIN.findall(r)), len(_FOREIGN.findall(r))
        if lr + nr >= 4 and lq + nq and (lq > nq) != (lr > nr):
            return True
    sr = _scores(_own_words(r, r_words))
    if max(sr) < 2:
        return False
    sq = _scores(_own_words(q, q_words))
    best = max(sq)
    if best < 1:
        return False
    own = max(x for x, y in zip(sr, sq) if y == best)  # words of the question's own language
    for k, n in enumerate(sr):
        others = max(sr[:k] + sr[k + 1 :])
        asked = max(sq[:k] + sq[k + 1 :])
        # the response is clearly in k, the question at least as clearly not
        if n >= 2 and n >= (others + 2 if others else 0) and sq[k] < asked and n > own:
            return True
    return False


def breaks_off(e: str) -> bool:
    """Whether a normal text ends inside a bracket, quotation, list, option or sentence."""
    if max(map(e.rfind, "([{")) > max(map(e.rfind, ")]}")):
        return True
    if e.count('"') % 2 and ((at := e.rfind('"')) == 0 or e[at - 1] in " ("):
        return True
    if not e.isascii():
        if e.rfind("«") > e.rfind("»") or e.rfind("„") > max(e.rfind("“"), e.rfind("”")):
            return True
        if _OPEN_GERMAN.search(e) and not _GERMAN.search(e):
            return True
    if e[-1] in ",:;=|&/+-–—…" or e.endswith("..") or ("--" in e and _OPTION.search(e)) or (e[-1] == ")" and _NUMBER.search(e)) or (e[-1] in "*•" and _BULLET.search(e)):
        return True
    if " " not in e or e[-1] in ')"”»' or _CLOSED.search(e):
        return False
    tail = _TAIL.search(e)
    return tail is not None and tail[1] in _OPEN_ENDS


def judge(kind: str, q: str | None, r: str | None) -> tuple[int, str | None]:
    """(the rules that hold, as bits in ORDER; the last word, to be looked up in the corpus, or None) of one pair."""
    t = normal(r or "")
    labelled = _LABEL.match(t)
    words = _WORD.findall(t, labelled.end() if labelled else 0)
    if not words:
        return EMPTY, None
    mask, r_words = 0, set(words)
    question = normal(q or "")
    asked = _WORD.findall(question)
    q_words = set(asked)
    # copy: the question once or several times, and nothing else but words that introduce it
    if asked and len(words) >= len(asked) and r_words <= q_words | _INTRO and f" {' '.join(asked)} " in f" {' '.join(words)} ":
        mask |= COPY
    if refuses(t, r_words):
        mask |= REFUSAL
    if kind == "qa" and asked and other_language(q, r, q_words, r_words):
        mask |= WRONG_LANGUAGE
    if breaks_off(t):
        return mask | TRUNCATED, None
    if kind == "qa" and " " in t and t[-1].isalpha() and (last := _LAST.search(t)):
        return mask, last[1]
    return mask, None


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at, masks, lasts = [], [], []
        for i, (kind, q, r) in enumerate(zip(*[b.column(c).to_pylist() for c in ("kind", "q", "r")])):
            mask, last = judge(kind, q, r)
            if mask or last:
                at.append(i)
                masks.append(mask)
                lasts.append(last)
        yield pa.RecordBatch.from_arrays([b.column("block_id").take(pa.array(at, pa.int64())), pa.array(masks, pa.int32()), pa.array(lasts, pa.string())], names=["block_id", "mask", "last"])


def pairs_of(blocks: DataFrame) -> DataFrame:
    """(block_id, kind, q, r): pairs of type qa or do."""
    b = blocks.where(F.col("type").isin("qa", "do") & F.col("block_id").isNotNull())
    return b.select("block_id", F.col("type").alias("kind"), "q", F.when(F.col("type") == "qa", F.col("a")).otherwise(F.col("do")).alias("r"))


def whole_words(blocks: DataFrame) -> DataFrame:
    """(word): distinct words of the corpus that stand somewhere with something after them, over all rows and fields."""
    t = F.lower(F.concat_ws(" \u0001 ", *[F.concat(F.col(c), F.lit("")) for c in ("q", "a", "text")]))
    w = F.explode(F.regexp_extract_all(t, F.lit(r"([\p{L}\p{N}]++)(?=[^\p{L}\p{N}\u0001]*(?:[\p{L}\p{N}!?。]|(?<!\.)\.(?!\.)))"), F.lit(1)))
    return blocks.select(w.alias("word")).distinct()


def defects(blocks: DataFrame) -> DataFrame:
    """Rows (block_id, defects, defect) for every pair of type qa or do with at least one defect.

    ``defects`` has every rule that holds, each tested whatever the others say, in the order empty, copy, refusal,
    wrong_language, truncated; ``defect`` is the first. An empty response has nothing for the other rules to read.
    Null and blank responses are empty; a null question can be neither copied nor in another language. A
    repeated block_id counts once (should its deliveries differ, with all their defects); rows with a null id or
    another type are left out. An empty table gives no rows.

    Responses that end without a stop in a word no other text has whole are truncated in the middle of that word. Only
    the distinct last words meet the words of the corpus; the unknown ones meet the pairs again, hot ones by broadcast.
    """
    kind = blocks.schema["block_id"].dataType.simpleString()
    flagged = materialize(pairs_of(blocks).mapInArrow(_judged, f"block_id {kind}, mask int, last string"), "flags")
    lasts = flagged.where("last is not null").groupBy(F.col("last").alias("word")).agg(F.count("*").alias("n"))
    cut = materialize(lasts.join(whole_words(blocks), "word", "left_anti").select(F.col("word").alias("last"), "n", F.lit(TRUNCATED).alias("cut")), "cut")
    looked = hot_split_join(flagged.where("last is not null"), cut, "last", "n", keep_key=False).select("block_id", F.col("mask").bitwiseOR(F.col("cut")).alias("mask"))
    # a row with a rule and a last word comes twice at most
    one = flagged.where("mask <> 0").select("block_id", "mask").unionByName(looked).groupBy("block_id").agg(F.bit_or("mask").alias("mask"))
    found = F.filter(F.array(*[F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.lit(c)) for i, c in enumerate(ORDER)]), lambda x: x.isNotNull())
    return one.select("block_id", found.alias("defects")).withColumn("defect", F.col("defects")[0])
