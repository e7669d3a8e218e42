"""Training-data operators: near-duplicates, tokens, personal data, fingerprints, languages,
mixing, toxicity, repeated lines and language-model scores.  One module per operator;
``queries`` registers one query for each, ``oracles`` holds their SQL where SQL can say it."""
