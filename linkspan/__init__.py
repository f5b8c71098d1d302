"""Entity resolution as Spark plans: normalisation, blocking, pair features, decisions and evaluation."""
