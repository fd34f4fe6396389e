"""Operations of a training-data pipeline (quality, toxicity, duplicates, packing ...).

Nothing outside this package imports it; ``catalog`` lists its queries.
"""
