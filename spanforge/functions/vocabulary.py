"""Labels, kinds, phrases, character classes and thresholds that results depend on."""

# Labels of spans.
SUMMARY = "Sumario"
MARKER = "SERIE_III"
ORG = "ORG_LABEL"
ORG_STAR = "ORG_WITH_STAR_LABEL"
TITLE = "DOC_NAME_LABEL"
BODY = "DOC_TEXT"
PARAGRAPH = "PARAGRAPH"
JUNK = "JUNK_LABEL"

# Phrases that are labelled wherever they stand.
PHRASES = {
    "**Sumário**": SUMMARY,
    "**Sumario**": SUMMARY,
    "Direção Regional do Trabalho": MARKER,
    "Direcção Regional do Trabalho": MARKER,
}

# Bold titles known by name, besides those with a lower-case letter.
KNOWN_TITLES = [
    "Regulamentação do Trabalho",
    "Portarias de Extensão:",
    "Convenções Colectivas de Trabalho:",
    "Despachos:",
    "Regulamentos de Condições Mínimas:",
    "Estatutos/Alterações:",
]

# Characters of a noise line, besides digits and white space; its greatest length.
JUNK_MARKS = "-–—.,;:·•*'\"`´+=()[]{}/\\<>~^_|"
JUNK_LENGTH = 20

# What may stand between organisation headings that are one name.
GAP_MARKS = "•-–,.;:"
MAX_MERGE = 3

# Letters with accents and their base letters (canonical decompositions of Latin-1), and the two ordinal signs that only the compatibility form decomposes.
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
BASE = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"
ORDINALS = "ªº"
ORDINAL_BASE = "ao"

# White space of Unicode.
WHITE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# Capitals of the letter-spacing rule.
SPACED_CAPS = "A-ZÁÂÃÀÇÉÊÍÓÔÕÚÜ"

# Kinds of relation.
ORG_TITLE = "ORG→DOC_NAME"
ORG_TO_STAR = "ORG→ORG*"
STAR_ORG = "ORG*→ORG"
STAR_TITLE = "ORG*→DOC_NAME"
TITLE_BODY = "DOC_NAME→DOC_TEXT"
TITLE_PARAGRAPH = "DOC_NAME→PARAGRAPH"
ORG_BODY = "ORG→DOC_TEXT"
ORG_PARAGRAPH = "ORG→PARAGRAPH"
KIND_ORDER = [ORG_TITLE, ORG_TO_STAR, STAR_ORG, STAR_TITLE, TITLE_BODY, TITLE_PARAGRAPH]

# Title matching: confidence of each pass, least ratio of lengths, trigrams.
CONFIDENCE = {"exact": 1.0, "tight": 0.95, "letters": 0.9, "contained": 0.8}
LEAST_RATIO = 0.80
LEAST_JACCARD = 0.60
GRAM = 3
GRAM_LETTERS = "0123456789abcdefghijklmnopqrstuvwxyz"
GRAM_CODES = len(GRAM_LETTERS) ** GRAM
LEAST_GRAM_LETTERS = 20
