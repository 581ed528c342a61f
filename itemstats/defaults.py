"""Default parameters of the analyses.

Fixed values of the reference (results match it only with these): the high /
low group fraction, rounded half up; minimum support and confidence of the
item and knowledge-point rules; the difficulty bounds outside which items are
left out of item rules (strict, the bounds themselves are kept); k and the
iteration cap of k-means; the difficulty bands of a cluster's strong and weak
items (inclusive).
"""

GROUP_FRACTION = 0.27
ITEM_SUPPORT = 0.6
KNOWLEDGE_SUPPORT = 0.65
CONFIDENCE = 0.85
EXTREME_LO, EXTREME_HI = 0.2, 0.8
K, MAX_ITER = 4, 20
GOOD = (0.7, 0.8)
BAD = (0.2, 0.3)

# Our own choices (not in the reference): k-means stopping tolerance, as MLlib's
# default, and the seed of the reproducible k-means++ seeding.
TOL, SEED = 1e-4, 42
# k-means||: rounds of oversampling, weighted Lloyd steps on the candidates, first step number of their draws.
ROUNDS = 2
RECLUSTER_STEPS = 5
CANDIDATE_STEP = 1000
