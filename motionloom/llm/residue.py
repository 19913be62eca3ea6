"""Template residue, filler and error-page text (problem 9).

Pass 1 counts, over all distinct texts, the words, and by host the normalised lines and the texts, under 64-bit hashes.
Texts themselves are not shuffled: each batch hands on, per word, up to ``LEAST_COUNT + 1`` hashes of texts that have it,
and per short line of a host the hashes of its texts. A word is common in more than ``LEAST_COUNT`` texts; a line is
recurrent in more than ``LEAST_COUNT - 1`` texts of its host and more than ``LINE_SHARE`` of them. So texts of other
hosts and with other words change no verdict. The hashes of common words and recurrent lines go to the tasks as sorted
arrays (eight bytes each).
Pass 2 subtracts from each record the recurrent boilerplate lines of its host (short lines without closing
punctuation) and judges what is left:

* ``placeholder``: an unfilled template place, outside sentences that speak about the place itself;
* ``filler``: nothing but stock filler phrases or filler Latin, one repeated sign or token, or words most of which hardly
  occur elsewhere;
* ``error``, ``script`` or ``sign_in``: mostly an error message or a notice that scripts, sign-in or permission are
  needed. Each sentence is weighed by the classifier of ``messages``, which adds to or outvotes the patterns below;
  sentences that report about such messages do not count.

Whole batches are looked over with vectorised expressions first; only records that have a sign of residue anywhere, or
whose residual words are mostly rare, are judged one by one.

Defined results: null and blank texts are no cases and stay in the corpus; a null source is a host of its own;
copies of a text are counted once and judged alike; repeated rows give repeated equal verdicts; a text that is all
boilerplate has no residual and is no case; very long texts are judged whole; an empty input gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionloom.llm.messages import CLASSES, message_model
from motionloom.llm.mixing import plain_source
from motionloom.session import checkpointed

LEAST_COUNT = 3
LINE_SHARE = 5e-5
#: Log odds a sentence needs to count as a message, and what a telling and a common turn of phrase add to them.
MESSAGE_ODDS, TELLING_ODDS, COMMON_ODDS = 0.35, 2.2, 0.6
LINE_CHARS = 80
RARE_WORDS = 0.5
LEAST_WORDS = 3
REPEATED_TOKENS = 5

# HTML element names that are no template places even in capitals.
HTML_NAMES = "A ABBR B BIG BODY BR CENTER CODE DD DIV DL DT EM FONT FORM H1 H2 H3 H4 H5 H6 HEAD HR HTML I IMG INPUT LI LINK META OL OPTION P PRE S SCRIPT SELECT SMALL SPAN STRONG STYLE SUB SUP TABLE TBODY TD TH THEAD TITLE TR TT U UL".split()
PLACE = re.compile(
    r"\{\{\s*[\w.\- ]{1,60}?\s*\}\}|\$\{\s*[\w.\-]{1,60}\s*\}|<%=?\s*[\w.\- ]{1,60}?\s*%>|%\(\w{1,60}\)[sdif]|@@\w{1,60}@@|\[\[\s*[\w ]{1,60}?\s*\]\]"
    r"|\[(?:TODO|TBD|FIXME|INSERT)\b[^\[\]\n]{0,80}\]|\[(?:your |insert |enter )?[\w ]{1,60} here\]|\[insert [\w ]{1,60}\]|<(?:insert|enter|your) [\w ]{1,60}>"
    r"|<(?!/?(?:" + "|".join(HTML_NAMES) + r")>)[A-Z][A-Z0-9_]{1,60}>|__[A-Z][A-Z0-9_]{0,60}__|(?<![\w])X{4,}(?![\w])(?! (?:series|models?|class|type|range)\b)|(?<![\w${])\{[A-Za-z]\w{1,60}\}(?!\})"
    r"|%[A-Z][A-Z_]{1,40}%|\[(?:(?:First|Last|Full|Your|Company|Customer|Recipient|Client|User|Product|Event|Street|Email|Phone|Job|Insert) ?)+(?:Name|Address|Date|Title|Number|Email|Company|City|Time|Phone|Signature)?\](?!\()"
    r"|\b(?:INSERT|ENTER|TYPE|PASTE|ADD|YOUR)(?: [A-Z]+){0,4} HERE\b"
)
#: A sentence that speaks about the place instead of leaving it open.
ABOUT_PLACE = re.compile(
    r"(?i)\b(?:is|are|was|were|gets?|being)\s+(?:then\s+)?(?:replaced|resolved|substituted|expanded|rendered|filled)\b|\bprinted on\b|\bthe (?:form|syntax|pattern|variable|placeholder|marker)\b"
    r"|\bfilled\b.{0,40}\bin by\b|\bwrite it exactly\b|\bplaceholders?\b|\bstands? (?:in )?for\b|\bwird\b.{0,60}\bersetzt\b|\bse (?:sustituye|reemplaza)\b|\bPlatzhalter\b|\bmarcador\b|占位符|替换"
)
# Stock filler phrases.
FILLER = (
    r"lorem ipsum(?: dolor(?: sit amet)?)?|sample text|dummy (?:line|text)|placeholder (?:paragraph|text)|(?:your )?(?:text|content)(?: goes)? here|(?:bla+h?\s*)+|foo(?: bar)?(?: baz)?|(?:asdf\w*)|qwerty\w*"
    r"|test(?: test)*(?: \d+)*|(?:abc)+|filler(?: text)?|beispieltext|blindtext|mustertext|texto de (?:relleno|ejemplo)|示例文字|示例文本|占位文字|测试文字|x{3,}"
)
_FILLER = re.compile(rf"(?i)(?:(?<!\w)(?:{FILLER})(?!\w)|示例文字|示例文本|占位文字|测试文字)")

#: Words of the customary filler Latin.
LATIN = frozenset(
    """ac accumsan adipiscing aenean aliqua aliquam aliquet amet ante arcu at auctor augue bibendum blandit commodo condimentum congue consectetur consequat convallis cras cursus dapibus diam dictum dignissim dis dolor dolore donec
    dui duis efficitur egestas eget eiusmod eleifend elementum elit enim erat eros est et eu euismod ex facilisis fames faucibus felis fermentum feugiat finibus fringilla fusce gravida habitasse hac hendrerit iaculis id imperdiet in
    incididunt integer interdum ipsum justo labore lacinia lacus laoreet lectus leo libero ligula lobortis lorem luctus maecenas magna malesuada massa mattis mauris metus mi minim mollis morbi nam nec neque nibh nisi nisl non nostrud
    nulla nullam nunc odio orci ornare pellentesque pharetra placerat porta porttitor posuere praesent pretium proin pulvinar purus quam quis risus rutrum sagittis sapien scelerisque sed sem semper sit sodales sollicitudin""".split()
)
_LATIN_SHARE, _LATIN_WORDS = 0.7, 4

_SCRIPT = r"(?:java\s?script|\bjs\b|webgl|\b(?:active )?scripts?\b|\bscript support\b|\bscripting\b|noscript|脚本)"
SCRIPT = re.compile(
    rf"(?i)(?:\b(?:enable|turn on|switch on|allow|activate|need(?:s|ed)?|require[sd]?|without|disabled|blocked|must have|does not (?:run|support)|unsupported)\b.{{0,60}}{_SCRIPT}"
    rf"|{_SCRIPT}.{{0,80}}\b(?:enabled?|is (?:off|needed|required)|are (?:off|blocked|needed|required)|disabled|blocked|required|needed|turned? (?:on|off)|switched (?:on|off)|allow|switch it on)\b"
    rf"|\b(?:aktivier\w*|benötig\w*|erforderlich|einschalten|erlauben)\b.{{0,60}}{_SCRIPT}|{_SCRIPT}.{{0,60}}\b(?:aktivier\w*|benötig\w*|erforderlich|eingeschaltet|erlaub\w*)\b"
    rf"|\b(?:active|activar|habilit\w*|necesita|requiere)\b.{{0,60}}{_SCRIPT}|{_SCRIPT}.{{0,60}}\b(?:activad\w*|habilitad\w*|necesari\w*)\b|(?:启用|开启|打开|需要).{{0,20}}{_SCRIPT}|{_SCRIPT}.{{0,20}}(?:启用|开启|禁用|需要))"
)
SIGN_IN = re.compile(
    r"(?i)\b(?:please )?(?:sign|log) in(?: again)? (?:to|first|with)\b|\bplease (?:sign|log) in\b|\b(?:you )?(?:must|need to|have to) (?:sign|log) in\b|\b(?:session|login) (?:has )?(?:expired|ran out|timed out|ended)\b|\bpermission (?:to|is needed|required)\b|\bneed permission\b"
    r"|\baccess (?:is )?(?:denied|restricted)\b|\bnot (?:authori[sz]ed|allowed) to\b|\bdo not have the (?:right|permission)\b|\bmembers only\b|\bzugriff verweigert\b|\b(?:bitte )?(?:melden sie sich|anmelden)\b|\banmeldung erforderlich\b|\bkeine berechtigung\b"
    r"|\binicie sesión\b|\biniciar sesión\b|\bacceso denegado\b|\bno tiene permiso\b|请(?:先)?登录|请重新登录|(?:没有|无)权限|需要(?:登录|权限)|拒绝访问"
)
_REASON = r"(?:not found|forbidden|gone|unauthori[sz]ed|bad request|bad gateway|gateway time-?out|internal(?: server)? error|service unavailable|request time-?out|slow down|too many requests|not implemented|conflict|method not allowed|payload too large)"
#: Turns of phrase that hardly occur but in messages.
ERROR = re.compile(
    rf"(?i)(?:^|\b)(?:http(?:/\d(?:\.\d)?)?|errors?|fehler|código|code|status)\s*[:=#-]?\s*(?:code\s*)?[45]\d\d\b|错误\s*[:：]?\s*[45]\d\d|^\W*[45]\d\d\b[\s:–—-]*{_REASON}|^\W*{_REASON}\W*(?:\([45]\d\d\))?\W*$|^\W*[45]\d\d\W*$|\(\s*(?:error |fehler )?[45]\d\d\s*\)"
    r"|\bsomething went wrong\b|\b(?:unable|failed) to (?:load|open|display|show|connect|fetch)\b|\bloading\b.{0,60}\bfailed\b|\bpage not found\b|\bdown for maintenance\b|\bunder maintenance\b|\btimed out after\b|\btoo many requests\b|\btraceback\b|\bno (?:content|output) produced\b|\bserver error\b|\bstack trace\b"
    r"|\bseite nicht gefunden\b|\bist ein fehler aufgetreten\b|\bwartungsarbeiten\b|\berror interno\b|\bpágina no encontrada\b|\bha ocurrido un error\b|页面不存在|已被删除|加载失败|无法(?:加载|打开|显示)|服务器(?:内部)?错误|系统维护|请求超时|出错了"
)
#: Turns of phrase that messages share with real text.
COMMON = re.compile(
    r"(?i)\bcould not (?:be )?(?:load|open|display|show|found)\w*\b|\bcannot be (?:drawn|loaded|shown|displayed|opened)\b|\b(?:is|are) not available\b|\bno longer (?:exists?|available)\b|\bdoes not exist\b|\bis not on this\b|\bdid not answer\b"
    r"|\bkonnte nicht (?:geladen|geöffnet|angezeigt) werden\b|\bnicht (?:mehr )?verfügbar\b|\bno se pudo (?:cargar|abrir|mostrar)\b|\bno (?:está )?disponible\b"
)
#: A sentence that reports about a message or quotes it.
REPORTED = re.compile(
    r"(?i)\b(?:yesterday|last (?:week|night|shift)|once|for \w+ (?:minutes|hours)|restarted|retry worked|we (?:logged|saw|got|had)|stayed \w+ until|if it says|if you see|it says|on purpose|was withdrawn|had (?:scripts|javascript)|printed error|the word|column notes|means|means that|says that|gestern|einmal|neu gestartet|ayer|una vez|reiniciamos|昨天|一次)\b"
)
#: Sentences that usually follow a message.
_TAIL = re.compile(
    rf"(?i)^\W*(?:(?:reference|request|id|ref|incident|trace)\W*[\w\-–: ]{{1,40}}|{_REASON}|nothing to show|go back.{{0,40}}|reload.{{0,40}}|please (?:try|reload|go|wait|come|contact).{{0,80}}|try again.{{0,40}}|contact .{{0,60}}|wait \d+.{{0,60}}|back at .{{0,30}}|turn (?:it|them) on.{{0,60}}|switch (?:it|them) on.{{0,60}}|allow (?:it|them).{{0,60}}|oops|sorry|we use cookies.{{0,80}}|accept (?:all|cookies).{{0,40}}|返回.{{0,20}}|请.{{0,20}})\W*$"
)
_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])|\n+")

#: Sentences longer than this are weighed by their clauses.
CLAUSE_CHARS = 240
_CLAUSE = re.compile(r"""[,;|{}\[\]]+\s*|:\s+|\s+[-–—]\s+""")
#: Frames of a stack trace.
_FRAME = re.compile(r"""(?i)\bFile \\?"[^"\n]{1,200}", line \d+(?:, in \S{1,80})?|\bat [\w.$<>/]{1,200}\((?:[\w.$ /]{1,120})?(?::\d+){0,2}\)|"(?:timestamp|path|trace|request_?id)"\s*:\s*"[^"\n]{0,200}\"""")


# A sentence without any of these is no message, a text without any of these no filler phrase and no place.
_MESSAGE_STEMS = (
    "script", "js", "webgl", "脚本", "sign in", "log in", "login", "session", "permission", "access", "authori", "allowed to", "have the right", "members only", "verweigert", "anmeld", "melden sie",
    "berechtigung", "sesión", "acceso", "permiso", "登录", "权限", "error", "fehler", "错误", "went wrong", "could not", "cannot be", "unable to", "failed to", "loading", "not available", "no longer", "not exist",
    "not found", "is not on this", "maintenance", "timed out", "too many", "not answer", "traceback", "content produced", "stack trace", "gefunden", "konnte nicht", "verfügbar", "wartung", "no se pudo",
    "página", "disponible", "页面", "删除", "加载", "无法", "服务器", "维护", "超时", "出错", "拒绝",
)
#: Reasons stand alone or beside a status number, so they count in short sentences.
_REASON_CHARS = 60
#: Mean leaning of its words to messages from which a text without any stem is judged too.
LEANING = 0.05
_REASON_STEMS = ("forbidden", "bad request", "bad gateway", "internal", "unavailable", "timeout", "time-out", "slow down", "conflict", "not implemented", "not allowed", "too large")
_FILLER_STEMS = ("lorem", "text", "dummy", "placeholder", "here", "bla", "foo", "asdf", "qwerty", "test", "abc", "filler", "relleno", "ejemplo", "示例", "占位", "测试", "xxx")
_PLACE_SIGNS = ("{", "<", "%(", "@@", "[", "__", "XXXX", "%", "HERE")
#: The one reason that is also a common word: it counts alone.
_GONE = re.compile(r"(?i)\W*gone\W*$")
_STATUS = re.compile(r"[45]\d\d")
_ASCII_WORD = re.compile(r"[a-z]+")


def counted_words(text: str) -> list[str]:
    """Stretches of plain letters, as they are counted."""
    return _ASCII_WORD.findall(text.lower())


class Recurrent:
    """Whether a line or word is recurrent, told by its hash and remembered."""

    def __init__(self, kind: str, hashes: np.ndarray) -> None:
        self.kind, self.hashes, self.known = kind, hashes, {}

    def __contains__(self, text: str) -> bool:
        known = self.known.get(text)
        if known is None:
            if len(self.known) > 500_000:
                self.known.clear()
            h = hashed(self.kind, text)
            at = int(self.hashes.searchsorted(h))
            known = self.known[text] = at < len(self.hashes) and int(self.hashes[at]) == h
        return known


def sentences(text: str) -> list[str]:
    """Sentences and lines of a text."""
    return [s.strip() for s in _SENTENCE.split(text) if s.strip()]


@lru_cache(maxsize=1)
def _stems() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for stem in _MESSAGE_STEMS + _REASON_STEMS:
        out.add_word(stem, stem)
    out.make_automaton()
    return out


def may_tell(sentence: str) -> bool:
    """Whether a sentence has a stem of a message, a status number, or words that lean to messages."""
    low = sentence.lower()
    if next(_stems().iter(low), None) is not None or _STATUS.search(low) or _GONE.match(low):
        return True
    lean = message_model().leaning
    return sum(lean(w) for w in _ASCII_WORD.findall(low)) > 0


def short_lines(lines: pa.Array) -> pa.Array:
    """The normalised forms of lines that could be boilerplate: short, no closing punctuation, digits as zero; else null."""
    plain = pc.utf8_trim_whitespace(pc.replace_substring_regex(lines, r"\s+", " "))
    able = pc.and_(pc.and_(pc.not_equal(plain, ""), pc.less_equal(pc.utf8_length(plain), LINE_CHARS)), pc.invert(pc.match_substring_regex(plain, "[.!?。！？:：;,]$")))
    return pc.if_else(able, pc.replace_substring_regex(pc.utf8_lower(plain), r"[0-9]+", "0"), None)


def hashed(kind: str, text: str) -> int:
    """Signed 64-bit hash of a counted thing."""
    h = xxhash.xxh64_intdigest(f"{kind}\x00{text}")
    return h - (1 << 64) if h >> 63 else h


def telling(sentence: str) -> str | None:
    """The kind of message whose turns of phrase a sentence has."""
    low = sentence.lower()
    stems = _MESSAGE_STEMS if len(sentence) > _REASON_CHARS else _MESSAGE_STEMS + _REASON_STEMS
    if not any(stem in low for stem in stems) and not _STATUS.search(sentence) and not _GONE.match(sentence):
        return None
    return "script" if SCRIPT.search(sentence) else "sign_in" if SIGN_IN.search(sentence) else "error" if ERROR.search(sentence) else None


def evidence(sentence: str) -> str | None:
    """What a message-like sentence tells: ``error``, ``script`` or ``sign_in``."""
    if REPORTED.search(sentence):
        return None
    told = telling(sentence)
    common = told is None and COMMON.search(sentence) is not None
    p = message_model().probabilities(sentence)
    odds = math.log(max(1e-9, 1 - p[0]) / max(1e-9, p[0])) + (TELLING_ODDS if told else COMMON_ODDS if common else 0.0)
    return None if odds < MESSAGE_ODDS else told or CLASSES[1 + int(p[1:].argmax())]


def weighed(sentence: str) -> tuple[str | None, int, int]:
    """What a sentence tells, its characters that tell it, and those that say something else.

    A long sentence is weighed clause by clause, frames of a stack trace count for neither side.
    """
    if len(sentence) <= CLAUSE_CHARS or REPORTED.search(sentence):
        e = evidence(sentence) if len(sentence) <= CLAUSE_CHARS else None
        return e, len(sentence) if e else 0, 0 if e or _TAIL.match(sentence) else len(sentence)
    found, told, other = None, 0, 0
    for clause in _CLAUSE.split(_FRAME.sub(" ", sentence)):
        e = evidence(clause)
        found = found or e
        told += min(len(clause), CLAUSE_CHARS) if e else 0
        other += max(0, len(clause) - CLAUSE_CHARS) if e else 0 if _TAIL.match(clause) else len(clause)
    return found, told, other


def has_place(text: str) -> bool:
    """Whether a text has a template place."""
    return any(sign in text for sign in _PLACE_SIGNS) and PLACE.search(text) is not None


def is_filler(text: str) -> bool:
    """Nothing but stock filler phrases, or one sign or token over and over."""
    low = text.lower()
    tokens = low.split()
    signs = "".join(tokens)
    if len(signs) >= 4 and signs == signs[0] * len(signs):
        return True
    if len(tokens) >= REPEATED_TOKENS and len({t.strip(".,;:!?") for t in tokens}) == 1:
        return True
    latin = _ASCII_WORD.findall(low)
    if len(latin) >= _LATIN_WORDS and len(LATIN.intersection(latin)) > 1 and sum(w in LATIN for w in latin) >= _LATIN_SHARE * len(latin):
        return True
    if any(stem in low for stem in _FILLER_STEMS) and _FILLER.search(text):
        rest = re.sub(r"[\W\d_]+", "", _FILLER.sub(" ", text))
        return len(rest) <= 0.1 * len(signs)
    return False


def is_gibberish(text: str, common: Recurrent | None) -> bool:
    """Mostly words that hardly occur in other texts, by their letters: made-up texts share their short words."""
    if common is None:
        return False
    words = counted_words(text)
    if len(words) < LEAST_WORDS or sum(map(len, words)) < 0.7 * len(re.sub(r"\s", "", text)):
        return False
    return sum(len(w) for w in words if w not in common) >= RARE_WORDS * sum(map(len, words))


def judge(text: str | None, boilerplate: frozenset[int] = frozenset(), words: Recurrent | None = None) -> tuple[str | None, str]:
    """Verdict (null: keep) and residual of one record; ``boilerplate`` numbers its recurrent lines, ``words`` tells the common ones."""
    if not text or not text.strip():
        return None, ""
    if any(ord(c) == 0xFEFF for c in text[:1]):
        text = text[1:]
    left = [line for k, line in enumerate(text.split("\n")) if k not in boilerplate or has_place(line) or is_filler(line) or (telling(line) and evidence(line))]
    residual = "\n".join(left).strip()
    if not residual:
        return None, ""
    parts = sentences(residual)
    if has_place(residual) and any(PLACE.search(s) and not ABOUT_PLACE.search(PLACE.sub(" ", s)) for s in parts):
        return "placeholder", residual
    if is_filler(residual):
        return "filler", residual
    asked = [s for s in parts if may_tell(s)]
    most = sum(map(len, asked))
    other = sum(map(len, parts)) - most
    if other > max(60, most):
        other -= sum(len(s) for s in parts if _TAIL.match(s) and not may_tell(s))
    if other > max(60, most):  # what speaks of something else outweighs all that could be a message
        gibberish = is_gibberish(residual, words) and not any(map(evidence, asked))
        return ("filler" if gibberish else None), residual
    tells = [weighed(s) for s in parts]
    found = next((e for e, _, _ in tells if e), None)
    if found is None:
        return ("filler" if is_gibberish(residual, words) else None), residual
    told, other = sum(t for _, t, _ in tells), sum(o for _, _, o in tells)
    return (found if other <= max(60, told) else None), residual  # a text with a message in words is no gibberish


# --- whole batches ------------------------------------------------------------------------------------------


class Batch:
    """Lines and words of a batch of texts as flat arrays."""

    def __init__(self, texts: pa.Array, hosts: pa.Array) -> None:
        cut = pc.split_pattern(texts, "\n")
        self.lines, self.text_of = cut.flatten(), pc.list_parent_indices(cut).to_numpy(zero_copy_only=False)
        words = pc.split_pattern_regex(pc.utf8_lower(self.lines), "[^a-z]+")
        line_of, flat = pc.list_parent_indices(words).to_numpy(zero_copy_only=False), words.flatten()
        sizes = pc.binary_length(flat).to_numpy(zero_copy_only=False)
        code = flat.dictionary_encode()
        self.vocabulary = code.dictionary.to_pylist()
        real = sizes > 0
        self.word, self.line_of, self.size = code.indices.to_numpy(zero_copy_only=False)[real], line_of[real], sizes[real]
        host = pc.take(hosts, pa.array(self.text_of))
        keys = pc.binary_join_element_wise(host, short_lines(self.lines), "\x00").dictionary_encode()
        self.line_key = keys.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        self.line_names = keys.dictionary.to_pylist()


COUNT_SCHEMA = "kind string, host long, key long, text long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What counts to each word, line and host: ``text`` is the hash of a text that has it."""
    for b in batches:
        if not b.num_rows:
            continue
        hosts, text = b.column("host").fill_null(""), b.column("hash").to_numpy(zero_copy_only=False)
        x = Batch(b.column("text"), hosts)
        text_id, text_no = np.unique(text, return_inverse=True)
        pairs = np.stack(np.divmod(np.unique(x.word.astype(np.int64) * len(text_id) + text_no[x.text_of[x.line_of]]), len(text_id)), axis=1)
        first = np.flatnonzero(np.append(True, pairs[1:, 0] != pairs[:-1, 0])) if len(pairs) else np.zeros(0, np.int64)
        rank = np.arange(len(pairs)) - np.repeat(first, np.diff(np.append(first, len(pairs))))
        pairs = pairs[rank <= LEAST_COUNT]
        word_key = np.array([hashed("w", w) for w in x.vocabulary], np.int64)
        seen = np.flatnonzero(x.line_key >= 0)
        lines = np.unique(np.stack([x.line_key[seen].astype(np.int64), x.text_of[seen]], axis=1), axis=0) if len(seen) else np.zeros((0, 2), np.int64)
        line_key = np.array([hashed("l", n) for n in x.line_names], np.int64)
        known: dict[str, int] = {}
        host = np.array([known.setdefault(h, hashed("h", h)) for h in hosts.to_pylist()], np.int64)
        n = [len(pairs), len(lines), len(text)]
        kinds = np.repeat(np.array(["w", "l", "h"], object), n)
        key = np.concatenate([word_key[pairs[:, 0]], line_key[lines[:, 0]], np.zeros(n[2], np.int64)])
        out_host = np.concatenate([np.zeros(n[0], np.int64), host[lines[:, 1]], host])
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(out_host), pa.array(key), pa.array(np.concatenate([text_id[pairs[:, 1]], text[lines[:, 1]], text]))], names=["kind", "host", "key", "text"])


def _known(names: list[str], kind: str, hashes: np.ndarray) -> np.ndarray:
    """Which names are among the hashes of a kind."""
    h = np.array([hashed(kind, n) for n in names], np.int64)
    if not len(h) or not len(hashes):
        return np.zeros(len(h), bool)
    return hashes[np.minimum(hashes.searchsorted(h), len(hashes) - 1)] == h


def _any_of(stems: tuple[str, ...]) -> str:
    return "|".join(re.escape(s) for s in stems)


#: Texts with any of these are judged one by one.
_PREFILTER = (
    "(?i:" + "|".join(map(re.escape, _MESSAGE_STEMS + _REASON_STEMS)) + "|[45][0-9][0-9]|lorem|dummy|placeholder|sample text|(?:text|content)(?: goes)? here|\\bbla+h?\\b|(?:^|\n)\\W*gone\\W*(?:\n|$)|\\bfoo\\b|asdf|qwerty|\\btest\\b|abcabc|\\babc\\b|filler"
    "|beispieltext|blindtext|mustertext|relleno|texto de ejemplo|示例|占位|测试|xxx)|[{<\\[%]|@@|__|XXXX|HERE"
)


def _verdicts(b: pa.RecordBatch, words: np.ndarray, lines: np.ndarray) -> list[str | None]:
    texts, hosts = b.column("text"), b.column("host").fill_null("")
    x = Batch(texts.fill_null(""), hosts)
    n = len(texts)
    recurrent = np.append(_known(x.line_names, "l", lines), False)[x.line_key]
    common = _known(x.vocabulary, "w", words)
    bare = pc.utf8_length(pc.replace_substring_regex(x.lines, r"\s+", "")).to_numpy(zero_copy_only=False)
    own = ~recurrent[x.line_of]
    of = x.text_of[x.line_of[own]]
    total = lambda v: np.bincount(of, v, n)
    size = x.size[own].astype(float)
    letters, rare, count = total(size), total(size * ~common[x.word[own]]), total(np.ones(len(of)))
    signs = np.bincount(x.text_of[~recurrent], bare[~recurrent], n)
    gibberish = (count >= LEAST_WORDS) & (letters >= 0.7 * signs) & (rare >= RARE_WORDS * letters)
    seen = pc.fill_null(pc.match_substring_regex(texts, _PREFILTER), False).to_numpy(zero_copy_only=False)
    lean = np.array([message_model().leaning(w) for w in x.vocabulary])
    leaning = total(lean[x.word[own]]) > LEANING * np.maximum(count, 1)
    latin = total(size * np.isin(np.array(x.vocabulary, object), list(LATIN))[x.word[own]]) >= 0.5 * np.maximum(letters, 1)
    boilerplate: dict[int, set[int]] = {}
    first = np.searchsorted(x.text_of, np.arange(n))
    for at in np.flatnonzero(recurrent).tolist():
        boilerplate.setdefault(int(x.text_of[at]), set()).add(at - int(first[x.text_of[at]]))
    vocabulary = Recurrent("w", words)
    asked = gibberish | seen | latin | leaning
    return [judge(t, frozenset(boilerplate.get(k, ())), vocabulary if gibberish[k] else None)[0] if t and (asked[k] or len(set(t)) <= 16) else None for k, t in enumerate(texts.to_pylist())]


def _sorted_hashes(keys: DataFrame) -> np.ndarray:
    return np.sort(keys.toArrow().column("key").to_numpy())


def residue(documents: DataFrame) -> DataFrame:
    """Verdict per document: ``(doc_id, verdict)``, null for documents to keep."""
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text", plain_source(F.col("source")).alias("host"))
    real = docs.where(F.col("text").isNotNull() & (F.trim("text") != "")).select("text", "host", F.xxhash64("text").alias("hash"))
    counts = real.mapInArrow(_count, COUNT_SCHEMA).groupBy("kind", "host", "key").agg(F.count_distinct("text").alias("n"))
    counts = checkpointed(counts.where((F.col("kind") == "h") | (F.col("n") >= LEAST_COUNT)))
    common = counts.where((F.col("kind") == "w") & (F.col("n") > LEAST_COUNT)).select("key")
    hosts = counts.where(F.col("kind") == "h").select("host", F.col("n").alias("texts"))
    lines = counts.where(F.col("kind") == "l").join(hosts, "host").where(F.col("n") > F.lit(LINE_SHARE) * F.col("texts")).select("key")
    shared = spark.sparkContext.broadcast((_sorted_hashes(common), _sorted_hashes(lines)))  # eight bytes for each common word and recurrent line

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(_verdicts(b, *shared.value) if b.num_rows else [], pa.string())], names=["doc_id", "verdict"])

    return docs.mapInArrow(verdicts, "doc_id long, verdict string")
