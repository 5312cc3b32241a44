"""Names and constants that decide results and must stay as they are."""

# Years an event may start in to be ingested (inclusive).
SCOPE_FIRST_YEAR = 2025
SCOPE_LAST_YEAR = 2025

# An upper-cased event name holding one of these is out of scope.
SCOPE_REJECT_TOKENS = ("CHALLENGERS", "ASCENSION", "GAME CHANGERS", "GC", "PROMO")

# Otherwise it must hold at least one of these.
SCOPE_ACCEPT_TOKENS = ("PACIFIC", "EMEA", "AMERICAS", "CHINA", "MASTERS", "CHAMPIONS", "LOCK//IN")

# Match status that is ingested, compared in lower case.
COMPLETED_STATUS = "completed"

# Winner shown for a tie or an unknown score.
DRAW_LABEL = "Draw"

# Literals for attributes that a landed payload does not carry at all.
UNKNOWN = "unknown"
LISTING_DEFAULTS = {"id": "Unknown ID", "name": "Unknown Name", "start_date": "Unknown Date"}

# Text a null takes inside a record key.
NULL_IN_KEY = "None"

# Stamp of quarantine keys and run folders.
RUN_STAMP_FORMAT = "yyyyMMdd'T'HHmmss"
