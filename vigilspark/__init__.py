"""Drug-safety analytics as Spark jobs: adverse-event reports, trials, risk rules, alerts, models and streams."""
