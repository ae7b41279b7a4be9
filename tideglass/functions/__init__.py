from tideglass.functions.casting import lenient_cast
from tideglass.functions.display import fixed_percent, flag_url, thousands
from tideglass.functions.fingerprint import record_hash
from tideglass.functions.words import ENGLISH_STOP_WORDS, tokens

__all__ = [
    "ENGLISH_STOP_WORDS",
    "fixed_percent",
    "flag_url",
    "lenient_cast",
    "record_hash",
    "thousands",
    "tokens",
]
