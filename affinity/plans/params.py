"""Parameters of the catalogue queries over the driver tables.

Fixed values taken from the reference jobs:
    train cut 70 (strict <), preview cut 65 (strict <)
    top-N neighbours 50, prediction threshold 0.98
    rule mining: min support 0.1, min confidence 0.5 (the basket-file job)
    itemset boost: min support 0.15, weight 32
    course tiers: k = 3, epsilon 0.001; tier names easy / middle / hard
    microaggregation: k tried from 3 down, clusters need 2 members,
                      bands <60, 60-70, 70-80, 80-90, >=90, 3 decimals
The held-out cohort is the last (partial) order year of the driver data.
"""

HOLDOUT = "2001"
TRAIN_CUT = 70.0
PREVIEW_CUT = 65.0
TOP_N = 50
THRESHOLD = 0.98
LOW_THRESHOLD = 0.05  # keeps part of the driver data's scores
MIN_SUPPORT = 0.1
MIN_CONFIDENCE = 0.5
BOOST_SUPPORT = 0.15
BOOST_WEIGHT = 32.0
ORDER_MIN_SUPPORT = 0.1
ORDER_MIN_CONFIDENCE = 0.5
LLOYD_K = 3
EPSILON = 0.001
MICRO_DECIMALS = 3
KMAX_MICRO = 3
KMEANS_K = 4
KMEANS_ITER = 30
SEED = 7
TERM = "1999Q3"  # one term of the driver data
