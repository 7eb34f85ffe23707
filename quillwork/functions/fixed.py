"""These must be exactly as stated for results to be right."""

# Whitespace characters that separate words.  ASCII whitespace first, then the
# information separators, next-line, and the Unicode spaces.
ASCII_WHITESPACE = " \t\n\x0b\f\r"
UNICODE_WHITESPACE = (
    "\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Access-log line -> host, local time, path, bytes.
ACCESS_LOG_PATTERN = (
    r'^(\S+) - - \[(\S+) [+-]\d+\] "[A-Z]+ (\S+) HTTP/\d\.\d" \d+ (\d+)$'
)
MONTH_NAMES = [
    "Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
]

# Hour bucket in a page-view file name.
PAGE_FILE_HOUR_PATTERN = r"pagecounts-(\d{8}-\d{2})"

# Page titles that are not content.
FRONT_PAGE = "Main_Page"
SPECIAL_PREFIX = "Special:"

# sRGB and CIE LAB constants (illuminant D65, 2 degree observer).
SRGB_CUT = 0.04045
SRGB_OFFSET = 0.055
SRGB_SCALE = 1.055
SRGB_SLOPE = 12.92
SRGB_GAMMA = 2.4
RGB_TO_XYZ = [
    [0.412453, 0.357580, 0.180423],
    [0.212671, 0.715160, 0.072169],
    [0.019334, 0.119193, 0.950227],
]
WHITE_XYZ = [0.95047, 1.0, 1.08883]
LAB_CUT = 0.008856
LAB_SLOPE = 7.787
LAB_OFFSET = 16.0 / 116.0

# Representative colour of each colour word.
PALETTE = [
    ("red", 255, 0, 0),
    ("orange", 255, 114, 0),
    ("yellow", 255, 255, 0),
    ("green", 0, 230, 0),
    ("blue", 0, 0, 255),
    ("purple", 187, 0, 187),
    ("brown", 117, 60, 0),
    ("pink", 255, 187, 187),
    ("black", 0, 0, 0),
    ("grey", 150, 150, 150),
    ("white", 255, 255, 255),
]
