"""Default parameters of the drift pipeline.

Fixed values: these defaults equal the reference workflow's settings so that a
run with defaults makes the same decisions.
"""

# Known / Unknown cut on cosine similarity to the nearest campaign centroid.
SIM_THRESHOLD = 0.5
# Discovery gates and filters.
MIN_COVERAGE = 0.999
MIN_UNASSIGNED = 5
MIN_CLUSTER_MEMBERS = 3
# Naming.
N_SAMPLES = 5
MAX_WORDS = 5
CENTROID_SIM_THRESHOLD = 0.6
N_NEAREST = 5
# Extraction.
DILUTE_FACTOR = 10
TARGET_ROWS = 5000
# Density clustering (profile / discovery).
PROFILE_MIN_CLUSTER_SIZE = 5
PROFILE_MIN_SAMPLES = 1
PROFILE_SELECTION_EPSILON = 0.1
DISCOVERY_MIN_SAMPLES = 2
MIN_CLUSTER_FRAC = 0.01
MIN_CLUSTER_SIZE_FLOOR = 5
MIN_SAMPLES_FLOOR = 3
# Drift verdict.
ANOMALY_MARKER = "anomal"
# Display name cut.
DISPLAY_MAX_CHARS = 30
DISPLAY_KEEP_CHARS = 27
