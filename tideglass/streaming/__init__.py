from tideglass.streaming.idle import IdleLanding
from tideglass.streaming.keyed import KeyedSilver, silver_by_keys
from tideglass.streaming.landing import drain_topics, land_bronze, read_landed, read_rejects
from tideglass.streaming.silver import append_new_rows, silver_by_batch, silver_by_state

__all__ = [
    "IdleLanding",
    "KeyedSilver",
    "append_new_rows",
    "drain_topics",
    "land_bronze",
    "read_landed",
    "read_rejects",
    "silver_by_batch",
    "silver_by_keys",
    "silver_by_state",
]
