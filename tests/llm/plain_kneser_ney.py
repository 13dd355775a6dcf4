"""Class-conditional Kneser-Ney models by dictionaries of strings, as plain as can be."""

from collections import Counter
from math import log

from trackmill.llm.toxicity import DISCOUNT, grams


def plain_shared(seen):
    total, level = Counter(), seen
    while level:
        shorter = Counter(gram[1:] for gram in level if len(gram) > 1)
        total.update(shorter)
        level = set(shorter)
    of_context, followers = Counter(), Counter()
    for gram, n in total.items():
        of_context[gram[:-1]] += n
        followers[gram[:-1]] += 1
    found = {}
    for gram in sorted(total, key=len):
        context = gram[:-1]
        lower = found[gram[1:]] if context else 1.0 / (followers[""] + 1)
        found[gram] = (total[gram] - DISCOUNT + DISCOUNT * followers[context] * lower) / of_context[context]
    return found


def plain_evidence(counts):
    """Differences of seen expressions, and of contexts."""
    shared = plain_shared(set(counts[0]) | set(counts[1]))
    sums, followers = [Counter(), Counter()], [Counter(), Counter()]
    for label in (0, 1):
        for gram, n in counts[label].items():
            sums[label][gram[:-1]] += n
            followers[label][gram[:-1]] += 1

    def backoff(label, context):
        n = sums[label].get(context, 0)
        return DISCOUNT * followers[label][context] / n if n else 1.0

    def chance(label, gram):
        context = gram[:-1]
        own = max(counts[label].get(gram, 0) - DISCOUNT, 0) / (sums[label].get(context, 0) or 1)
        return own + backoff(label, context) * shared[gram[1:]]

    seen = {gram: log(chance(1, gram) / chance(0, gram)) for gram in set(counts[0]) | set(counts[1])}
    unseen = {c: log(backoff(1, c) / backoff(0, c)) for c in set(sums[0]) | set(sums[1])}
    return seen, unseen


def word_evidence(evidence, word):
    seen, unseen = evidence
    return sum(seen[g] if g in seen else unseen.get(g[:-1], 0.0) for g in grams(word))
