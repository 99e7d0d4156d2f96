"""Training-data operators: mixing, language, quality, personal data, near copies, secrets, contamination, licences, rules, repeats."""
