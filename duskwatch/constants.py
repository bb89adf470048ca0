"""Patterns, word lists and replacement tables that define the results.

They state WHAT has to match, so they are written out plainly and in natural order.
"""

import string
from datetime import date

# --- addresses -------------------------------------------------------------------------
ADDRESS = r"[a-z2-7]{55}d\.onion"
GATEWAY_ADDRESS = r"[a-z2-7]{55}d\."
VALID_ADDRESS = r"(^|\.)[a-z2-7]{56}\.onion$"
ADDRESS_SUFFIX = ".onion"
MIN_ADDRESS_LENGTH = 22

# --- noise patterns --------------------------------------------------------------------
NOISE_ADDRESS = r"\b[a-z2-7]{16,56}\.onion\b"
NOISE_PGP = r"-----BEGIN PGP PUBLIC KEY BLOCK-----.*?-----END PGP PUBLIC KEY BLOCK-----?"
NOISE_EMAIL = r"\s[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\s"
NOISE_MONEY = r"(%|USD|EUR|\$)\s?\d+(?:[.,]\d{3})*|\d+(?:[.,]\d)*\s?(USD|EUR|\$|BTC|%)"
NOISE_URL = (
    r"^(?:http|ftp)s?://"
    r"(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+(?:[A-Z]{2,6}\.?|[A-Z0-9-]{2,}\.?)|"
    r"(localhost)|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?::\d+)?(?:/?|[/?]\S+)$"
)
NOISE_BITCOIN = r"([13]|bc1)[A-HJ-NP-Za-km-z1-9]{27,34}"
WORD = r"\b[a-zA-Z]+\b"
WEB_TAGS = [
    "Contact", "Logic", "FAQ", "Login", "About", "Services", "Privacy", "Term", "Support",
    "Blog", "Team", "Contact Us", "Sign Up", "Sign In", "Register", "Dark Web", "TOR",
    "Onion Router", "Hidden Services", "Encryption", "Anonymity",
]

# --- cleaners --------------------------------------------------------------------------
REPEATED_PUNCTUATION = r"([^\w\s])\1+"
SPECIAL_CHARACTERS = '<#*_="+>'
SEPARATOR_REPLACEMENTS = [
    ("#", "."), (" -", ". "), (":)", ""), (" _", ". "), (" |", ". "), (" !", ". "),
    ("!", ". "), ("?", "? "), (" ?", "? "), (" :", ":"), ("( ", " ("), (" )", ") "),
    (" ;", ". "), (";", ". "), (" .", ". "), (":.", ":"), ("?.", "?"), ("-.", "."),
]
PUNCTUATION = string.punctuation

# --- sources, topics, datasets ---------------------------------------------------------
SOURCES = ["onions_farmer", "ioc_repositories", "gateways", "code_repositories"]
COLLECTION_PREFIX = "results_"
TOPIC_PREFIX = "crawlab_test."
OBJECT_BUCKET_PREFIX = "onions/"
FIRST_VERSION = date(2022, 11, 15)
FIRST_DAY = date(2022, 11, 1)
GREP_PAGE_CAP = 100
GREP_PAGE_SIZE = 10
GATEWAY_RESULT_CAP = 200
CRAWL_DEPTH = 3

# --- similarity ------------------------------------------------------------------------
MINHASH_PERMUTATIONS = 128
LSH_THRESHOLD = 0.5
# 25 bands of 5 rows minimise the equal-weight false positive + false negative area for
# threshold 0.5 within 128 permutations.
LSH_BANDS = 25
LSH_ROWS = 5
