"""Values that several tests share."""

# Nine short titles and the counts of their words.
TITLES = [
    "Human machine interface for lab abc computer applications",
    "A survey of user opinion of computer system response time",
    "The EPS user interface management system",
    "System and human system engineering testing of EPS",
    "Relation of user perceived response time to error measurement",
    "The generation of random binary unordered trees",
    "The intersection graph of paths in trees",
    "Graph minors IV Widths of trees and well quasi ordering",
    "Graph minors A survey",
]
TITLE_WORDS = "computer human interface response survey system time user eps trees graph minors".split()
TITLE_BOW = [
    [(0, 1), (1, 1), (2, 1)],
    [(0, 1), (3, 1), (4, 1), (5, 1), (6, 1), (7, 1)],
    [(2, 1), (5, 1), (7, 1), (8, 1)],
    [(1, 1), (5, 2), (8, 1)],
    [(3, 1), (6, 1), (7, 1)],
    [(9, 1)],
    [(9, 1), (10, 1)],
    [(9, 1), (10, 1), (11, 1)],
    [(4, 1), (10, 1), (11, 1)],
]
