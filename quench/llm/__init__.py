"""Training-data pipeline operators: packing, decontamination, toxicity, token
files, exact and near de-duplication, PII, secrets, HTML text and LM scores."""
