"""Character classes and patterns, in syntax that Java's regular expressions and RE2 share."""

# fixed values: the 29 white-space code points
SPACES = r"\t\n\x0B\x0C\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
# fixed values: letters and digits that count as word characters, and as native letters
WORD_CHAR = r"\p{L}\p{N}_"
WORD_BODY = "^(?:[A-ZÅÄÖ][a-zåäö]+|[a-zåäö]{2,})$"
SHORT_BODY = "^[a-zåäöA-ZÅÄÖ]$"
# fixed values: digits beside the decimal ones (superscripts, subscripts, circled and others)
OTHER_DIGITS = (
    r"\x{B2}\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}"
    r"\x{2488}-\x{2490}\x{24EA}\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}"
    r"\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)
DIGIT = rf"[\p{{Nd}}{OTHER_DIGITS}]"
# fixed values: upper-case letters, Roman numerals and circled capitals
UPPER = r"[\p{Lu}\x{2160}-\x{216F}\x{24B6}-\x{24CF}\x{1F130}-\x{1F149}\x{1F150}-\x{1F169}\x{1F170}-\x{1F189}]"
LETTERLIKE = r"[\p{L}\p{Nl}\p{No}]"
NATIVE = "[a-zA-ZåäöÅÄÖ]"
# fixed values: the 32 ASCII punctuation characters
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# fixed values: what the basic tokenizer deletes and what it makes tokens of their own
STRIPPED = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F\x{FFFD}\p{Cf}]"
ALONE = (
    r"[\p{P}\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}]"
)
# fixed value: the finer tokens, letter runs and single characters
TOKEN = rf"[\p{{L}}\p{{Nl}}\p{{No}}]+|[^{SPACES}]"
# fixed values: national identity numbers, and signs of HTML in a text
NATIONAL_ID = r"[0-9]{6}[A+\-][0-9]{3}[0-9A-Z]"
HTML_HINT = "<[/?]?[a-zA-Z0-9]|&[a-zA-Z0-9#]+;"
