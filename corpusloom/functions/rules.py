"""The patterns of text defects and of author fields.

Their names are the vocabulary of findings.  Patterns are in the common form of Java and
Python regular expressions, with flags inline; ``U`` stands for Unicode classes, which
Java must be told and Python has by default (see ``java``).
"""

from __future__ import annotations

TEXT_RULES = {
    "html_tag": (
        r"(?i)<\s*/?\s*(?:a|b|blockquote|body|br|div|em|font|h[1-6]|head|hr|html|i|img|li|ol|p|span|strong|sub|sup|table|tbody|td|th|thead|title|tr|u|ul)\b[^>]*>"
    ),
    "html_entity": r"(?i)&(?:#[0-9]+|#x[0-9a-f]+|[a-z][a-z0-9]+);",
    "zero_width": r"[​-‏‪-‮﻿]",
    "replacement_character": "�",
    "control_character": r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]",
    "probable_mojibake": r"(?:锟斤拷|烫烫烫|Ã[\x80-¿]|Â[\x80-¿]|â(?:€|€™|€œ|€œ|€“|€”|€¦)|ðŸ)",
    "ocr_markup": r"〖-?[A-Za-z]{2}[/；;][^〗]{1,80}〗",
    "ocr_markup_unclosed": r"〖-?[A-Za-z]{2}[/；;][^〗\r\n]{1,80}(?=\n?\Z)",
}

#: Author rules by pattern, found anywhere in the field.
AUTHOR_RULES = {
    "author_ocr_residue": r"(?i)(?:img\s*=|〖|〗|\bDW\s*[:：]|/?ct\b)",
    "author_placeholder": r"[�□]|\A\?|(?:锟斤拷|烫烫烫|Ã.|Â.)",
    "author_title_prefix": r"\A[—─━-]{2,}",
    "author_date_statement": r"\A(?:19\d{2}年.+(?:批准|公布|通过|起草)|[—─]{2,}一九\S+年)",
    "author_pure_noise": r"\A(?:\d|[^\w㐀-䶿一-鿿]{1,3})(?=\n?\Z)",
}
AUTHOR_IMAGE = r"(?i)\s*(?:<\s*[,，]?\s*)?img\s*=\s*[0-9a-z]+>?\s*"
AUTHOR_WRAPPED = r"\s*(?:\(.+\)|（.+）)\s*"
AUTHOR_ODD_EDGE = r"\A[、，。；：/）】』》”]|[、，；：/（【『《“](?=\n?\Z)"
AUTHOR_SENTENCE = r"[。！？；：]"
AUTHOR_PROSE = r"(?:文章|本文|作者|写道|指出|认为|他说|她说|叙述|论述|通过.+(?:表现|说明|揭示))"
AUDIT_PAIRS = ("()", "（）", "[]", "［］", "<>", "《》", "【】", "『』", "「」", "“”")
REVIEWED_LONG_AUTHORS = ("王性尧、胡子婴、胡厥文、郭棣活、盛丕华、汤蒂因、荣毅仁、刘靖基、魏如代表的联合发言",)
AUTHOR_LIMIT, AUTHOR_REVIEW, SENTENCE_LENGTH, PROSE_LENGTH, MANY_SLASHES = 80, 40, 12, 18, 3

#: Cleaning of texts: tags to take out, in addition to the classes above.
CLEAN_TAGS = (
    r"(?i)</?(?:html|head|body|title|img|font|br|span|b|strong|em|i|u|p|pre|div|a|sup|sub|hr|blockquote|h[1-6]|ul|ol|li|table|thead|tbody|tr|td|th)\b[^>]*>"
)

#: Any sign that the cleaning of texts could change: of entities, tags, invisible and control characters, layout marks.
DIRTY = r"[&<〖\x00-\x08\x0b\x0c\x0e-\x1f\x7f\u200b-\u200f\u202a-\u202e\ufeff]"

#: Cleaning of authors: fixed values.  Whole fields that are none, in their raw form:
RAW_NOT_AUTHORS = (AUTHOR_IMAGE, r"(?i)\s*DW\s*[:：]?\s*", r"(?i)\s*(?:/ct|ct)?\s*[<>]+\s*")
RAW_RECORD = r"(?i)〖-(?:ZQ|RQ|BH|TH|BT|FT|YT)/"
LAYOUT_MARK = r"(?i)〖HH/换行〗\s*DW：.*(?=\n?\Z)"
IMAGE_FRAGMENT = r"(?i)<?\s*img\s*=\s*[0-9a-z]+>?"
ANGLE_NOTE = r"<([^<>]{1,80})>"
NOTES_NOT_AUTHORS = r"\s*传达记录要点\s*"
BRACKET_SEGMENT = r"(?i)\s*[；;、,，]?\s*[\[［]\s*(?:机密|绝密|收时\s*\d+|\d+)\s*[\]］]"
SQUARE_BRACKETS = r"[\[\]［］]"
CUT_ANNOTATION = r"\s*[（(][A-Za-z][^）)]*(?=\n?\Z)"
WRAPPED = r"(?s)\s*(?:\((.*)\)|（(.*)）)\s*"
MISSING_BOOK_MARK = r"\A(人民日报|解放军报)》(.*)(?=\n?\Z)"
PUBLISHER_CREDIT = r"军事译文出版社出版）（([^（）]+)）"
REVIEW_NOTE = r"；阅办文件；?(?=\n?\Z)"
EDGE_MARKS = "、，；：/"
CLEAN_NOISE = (r"(?:\d|[《？])", r"(?i)\s*/?ct\s*")
MISPARSED_PROSE = r"(?:\A事由：|简介：.*简介：|图为.+[。！？])"
CLEAN_PAIRS = ("《》", "【】", "『』", "「」", "“”")

#: Archives with rules of their own: fixed values.
CLEANED_ARCHIVES = (3, 9, 10, 12, 14, 20, 24, 31)
NO_EMPTY_CONTENT, NO_REPLACEMENT = (10, 20, 24), 24
SPLIT_ALL, SPLIT_SLASH = 9, 24
SPLIT_DROPPED = "××"
SPLIT_RENAMED = {"贵州省委工作组?": "贵州省委工作组", "—毛远新给毛泽东的报告": "毛远新给毛泽东的报告"}
SPLIT_JOINED = "王性尧/胡子婴/胡厥文/郭棣活/盛丕华/汤蒂因/荣毅仁/刘靖基/魏如代表的联合发言"


def java(pattern: str) -> str:
    """The Java form: Unicode classes and case as Python has them, and the end of text spelled ``\\z``."""
    return "(?U)" + pattern.replace("(?i)", "(?iu)").replace(r"\n?\Z", r"\n?\z")
