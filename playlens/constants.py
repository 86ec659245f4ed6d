"""Texts, topic names and settings that outputs and inputs must agree on."""

# Message texts sent to listeners.
BANNER_MESSAGE = "Usuario: %s. Banner: %s"
RECOMMENDATION_MESSAGE = "GRUPO RECOMENDADO >>>>> %s"

# Marker for a user line of the wrong width.
USER_WIDTH_ERROR = "Error en Usuario, tamaño: %s"

# Topic names.
EVENT_TOPIC = "ineventos"
BANNER_TOPIC = "outpublicidad"
RECOMMENDATION_TOPIC = "outrecomendacion"

# A banner goes out on every tenth play of a user.
PLAYS_PER_BANNER = 10

# Micro-batch interval of the streams.
BATCH_INTERVAL = "2 seconds"

# Bytes at which an archive file is full.
ROLL_BYTES = 10_485_760_000

# Recommender settings: tuning grid, final model, split weights, seed.
GRID_RANKS = (8, 12)
GRID_ITERATIONS = (10, 20)
FINAL_RANK = 12
FINAL_ITERATIONS = 20
REGULARIZATION = 0.01
ALPHA = 1.0
SPLIT_WEIGHTS = (0.6, 0.2, 0.2)
SPLIT_SEED = 0

# The recommender stream scores for this user unless told to use the event's own.
FIXED_USER = 0

# Profile columns that must agree for two profiles to match.
PROFILE_KEYS = ("registered", "country", "gender", "age")
