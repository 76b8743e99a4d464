"""Training-data operators: corpus fingerprints, duplicate removal at line,
substring and document level, language-model and toxicity scores, chat
rendering, tokenisation and benchmark decontamination. Nothing else in the
library imports this subpackage."""
