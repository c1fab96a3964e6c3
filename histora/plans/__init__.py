"""Physical-plan helpers (ordered scans) and SQL views; import ``histora.plans.views`` for the views."""
