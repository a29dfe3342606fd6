"""Results depend on these exact constants and labels."""

# Price bands (open at both ends) and their labels.
PRICE_BANDS = [
    (0, 10, "10万以下"),
    (10, 30, "10-30万"),
    (30, 50, "30-50万"),
    (50, 70, "50-70万"),
    (70, 90, "70-90万"),
    (90, 110, "90-110万"),
    (110, 150, "110-150万"),
    (150, 200, "150-200万"),
    (200, 10000, "200万以上"),
]

# Price limits of the cleaned table, both ends kept.
PRICE_LIMITS = (1.5, 700)

# First registration year that is kept.
FIRST_YEAR = 2000

# Texts that stand for a missing value.
NO_DATA = "暂无数据"
UNKNOWN = "未知"
NOT_REGISTERED = "未上牌"

# Runs of common Chinese characters.
CJK_RUN = "[一-龥]+"

# Words: runs of letters, marks and numbers that are not Chinese; Chinese runs.
WORD_RUN = r"[\p{L}\p{M}\p{N}&&[^\p{IsHan}]]+"
HAN_RUN = r"\p{IsHan}+"

# Position literal in page text, and the forms of an id that need no prefix.
POSITION = "resblockPosition:'(.+),(.+)'"
ID_LINK_PREFIXES = ("BV", "av")
