"""Training-data operators: quality, toxicity, secrets, repeated passages,
compression rules, packing, language, decontamination, personal data and near
duplicates. Nothing outside this folder imports it."""
