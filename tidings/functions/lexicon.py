"""Word lists and patterns that results depend on, and packs of them that a caller may replace.

Only what text analysis needs is here. Editorial word lists (what to block, promote or review, which actors and places
count) are a caller's business: they come as a RulePack.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

# Classes that mean the same in Java's regular expressions and in RE2.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_WS = WS.replace("[", "[^", 1)
WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"

# What cleaning removes, in this order.
INVISIBLE = r"[\x{200b}-\x{200f}\x{202a}-\x{202e}\x{feff}]"
MARKS = r"[\x{591}-\x{5c7}]"
INLINE_TIME = rf"\({DIGIT}{{1,2}}/{DIGIT}{{1,2}}/{DIGIT}{{4}}{WS}+{DIGIT}{{1,2}}:{DIGIT}{{1,2}}\)"
URL = rf"https?://{NOT_WS}+|t\.me/{NOT_WS}+|www\.{NOT_WS}+"
EMOJI = r"[\x{1f000}-\x{1faff}\x{2600}-\x{27bf}\x{1f1e6}-\x{1f1ff}\x{2190}-\x{21ff}\x{2b00}-\x{2bff}\x{fe0e}\x{fe0f}\x{200d}]"

# Signatures and prompts of channels, each matched line by line, in this order.
BOILERPLATE = [
    r"שלחו לנו ידיעות.*$",
    r"להצטרפות לערוץ.*$",
    r"לחצו כאן להצטרפות.*$",
    r"הצטרפו לערוץ.*$",
    r"שיתוף בוואטסאפ.*$",
    rf"@{WORD}+",
    rf"#{WORD}+",
    rf"\|{WS}*צילום:.*$",
    rf"צילום:{WS}*{NOT_WS}+{WS}*$",
    r"\*?עכשיו בחנויות!?\*?",
    rf"אפליקציית ['\"׳״]?[\p{{L}}\p{{N}}_{WS[1:-1]}]{{1,20}}['\"׳״]?{WS}*רוצים לפרסם.*$",
    rf"יש לכם דיווח{WS}*/?{WS}*סיפור מעניין.*$",
    rf"לכוחותינו שלום\.?{WS}*$",
    rf"הישארו מעודכנים{WS}*\|.*$",
    rf"לתוכן נוסף הצטרפו ל{NOT_WS}+{WS}*>?{WS}*$",
    rf"{WS}*(?:אין תגובות|תגובה אחת|{DIGIT}+{WS}*תגובות){WS}*$",
    rf"(?:מעניין ממש )?לכל מה שקורה ביו[\"׳״]?ש בוואצאפ:?{WS}*$",
    rf"חדשות לפני כולם בטלגרם{WS}*$",
    rf"חדשות{WS}*55{WS}*שומרון{WS}*בווטסאפ:?{WS}*בטלגרם:?{WS}*$",
    rf"--{WS}*חדשות{WS}*השומרון{WS}*--(?s:.*)$",
    rf"הלל ביטון רוזן בטלגרם{WS}*$",
    rf"צופר{WS}*-{WS}*צבע אדום{WS}*$",
    rf"\({DIGIT}{{1,2}}/{DIGIT}{{1,2}}/{DIGIT}{{4}}\):{WS}*{DIGIT}{{1,2}}:{DIGIT}{{2}}:{WS}*",
    rf"{WS}*\({DIGIT}+{WS}*שניות\)",
]

# What a text must hold for each of these patterns to match, in the same order.
SIGNS = [
    "שלחו לנו ידיעות", "להצטרפות לערוץ", "לחצו כאן להצטרפות", "הצטרפו לערוץ", "שיתוף בוואטסאפ", "@", "#", "צילום:",
    "צילום:", "עכשיו בחנויות", "אפליקציית ", "יש לכם דיווח", "לכוחותינו שלום", "הישארו מעודכנים", "לתוכן נוסף הצטרפו ל",
    "תגוב", "לכל מה שקורה ביו", "חדשות לפני כולם בטלגרם", "שומרון", "השומרון", "הלל ביטון רוזן בטלגרם", "צבע אדום", "):", "שניות)",
]

# Letters attached to words, endings taken off (the first that fits), and words that carry no meaning.
ATTACHED = "בלמכשו"
ATTACHED_TO_NAMES = "בלמכשוה"
ENDINGS = ["יות", "ות", "ים", "יה", "ה", "ת"]
STOPWORDS = [
    "של", "את", "עם", "על", "אל", "כי", "גם", "או", "אך", "אם", "זה", "זו",
    "היא", "הוא", "הם", "הן", "אני", "אנחנו", "יש", "אין", "לא", "כן",
    "היה", "היתה", "יהיה", "כל", "רק", "עוד", "כבר", "אחרי", "לפני",
    "בין", "לפי", "מתוך", "אצל", "בתוך", "כמו", "מאוד", "יותר", "פחות",
    "עכשיו", "היום", "אתמול", "מחר", "כעת", "בוקר", "ערב", "לילה",
    "דיווח", "עדכון", "הודעה", "פרטים", "בהמשך", "מיד", "כרגע",
    "נפגעים", "דווח", "מסר", "נמסר", "הודיע", "מודיע", "כוחות",
    "במקום", "באזור", "אזור", "תושבים", "סמוך", "נערכים", "מדווח",
    "לדברי", "כאמור", "בשעה", "הבוקר", "הערב", "אמש",
    "זמן", "קצר", "חדש",
]

# Words of each severity, from the gravest down, and phrases that lower it.
SEVERITY = {
    "critical": [
        "פיגוע", "חדירת מחבלים", "אירוע ירי", "נפילה ישירה", "הרוג", "הרוגים",
        "נהרג", "נהרגו", "חטיפה", "נחטף", "פצוע אנוש", "במצב אנוש",
        "מטח רקטות", "ירי רקטות", "צבע אדום", "חדירת כלי טיס עוין",
        "מטען חבלה", "פיצוץ מטען", "דקירה", "פיגוע דריסה",
        "נפילת רקטה", "נפלה רקטה", "נפילת כטבם", "פגיעה ישירה",
    ],
    "high": [
        "פצועים", "נפצע", "נפצעו", "פצוע קשה", "אזעקה", "אזעקות",
        "יירוט", "יורט", "כתת כוננות", "התקפה", "תקיפה", "הופעל",
        "שריפה גדולה", "התפוצצות", "ירי לעבר", "חשד לחדירה",
        "פינוי מבנים", "נזק לרכוש", "כלי טיס חשוד", "רחפן חשוד",
    ],
    "medium": [
        "חשד", "עיכוב", "חסימת כביש", "הפגנה", "מהומות", "עימותים",
        "התפרעות", "מעצר", "נעצר", "נעצרו", "חקירה", "תאונה",
        "שריפה", "תקלה", "הפסקת חשמל", "פיקוד העורף", "הנחיות",
        "כוחות גדולים", "סריקות",
    ],
    "low": [
        "חזרה לשגרה", "הסתיים", "האירוע הסתיים", "שווא", "אזעקת שווא",
        "הוסרו ההגבלות", "אין נפגעים", "עדכון", "הודעה", "דיווח ראשוני",
        "ללא נפגעים", "בוטלה",
    ],
}
CALMING = [
    "אזעקת שווא", "התברר כשווא", "אין נפגעים", "ללא נפגעים",
    "האירוע הסתיים", "חזרה לשגרה", "הוסרו ההגבלות", "האזעקה בוטלה",
]
SEVERITIES = ["low", "medium", "high", "critical"]

# Markers of short follow-ups and of closed events.
FOLLOW_UP = ["נפגעים", "עודכן", "עדכון:", "חזר לשגרה", "בוטלה ההתרעה", "האירוע הסתיים", "המצב רגוע", "פונה נפגע"]
RESOLVED = [
    "חזר לשגרה", "חזרה לשגרה", "לחזור לשגרה", "אזעקת שווא", "כוזב", "כוזבת",
    "בוטלה ההתרעה", "ללא ממצא", "ללא ממצאים", "לא נמצא דבר",
    "לא נמצאו ממצאים", "לא נמצא כל ממצא", "לא אותרו ממצאים",
    "אין חשד לפעילות עוינת", "התברר כי לא", "התברר שמדובר בכוזב",
    "האירוע הסתיים", "סיום אירוע",
]
NO_TITLE = "דיווח ללא כותרת"


@dataclass(frozen=True)
class Reject:
    """A rule of the cascade: rejects a text that has a word of every list in `needs` and none of `unless`.

    `pattern`, if given, is an alternative to the last list of `needs`. `no_place` asks that no place was found.
    """

    reason: str
    needs: tuple[tuple[str, ...], ...]
    unless: tuple[str, ...] = ()
    pattern: str = ""
    no_place: bool = False


@dataclass(frozen=True)
class RulePack:
    """The words of one editorial line. Every list may be empty."""

    letters: str = r"[\x{5d0}-\x{5f2}]"
    least_share: float = 0.25
    least_letters: int = 10
    other_letters: str = r"[\x{600}-\x{6ff}\x{750}-\x{77f}\x{fb50}-\x{fdff}\x{fe70}-\x{feff}]"
    most_other: int = 3
    blocks: dict[str, list[str]] = field(default_factory=dict)
    ambiguous: tuple[str, ...] = ()
    context: tuple[str, ...] = ()
    no_context: tuple[str, ...] = ()
    ignored: tuple[str, ...] = ()
    rejects: tuple[Reject, ...] = ()
    live: tuple[str, ...] = ()
    past: tuple[str, ...] = ()
    statement: tuple[str, ...] = ()
    impact: tuple[str, ...] = ()
    weak: tuple[str, ...] = ()
    outbound: tuple[str, ...] = ()
    resolution: tuple[str, ...] = ()
    promote: tuple[str, ...] = ()
    review: tuple[str, ...] = ()
    meta: tuple[str, ...] = ()
    casualties: tuple[str, ...] = ()

    @classmethod
    def from_json(cls, text: str) -> RulePack:
        raw = json.loads(text)
        made = {f.name: tuple(raw[f.name]) if isinstance(raw[f.name], list) else raw[f.name] for f in fields(cls) if f.name in raw}
        if "rejects" in raw:
            made["rejects"] = tuple(Reject(**{k: tuple(map(tuple, v)) if k == "needs" else tuple(v) if isinstance(v, list) else v for k, v in r.items()}) for r in raw["rejects"])
        return cls(**made)
