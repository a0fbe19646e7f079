"""Settings, registered queries and whole pipelines."""
