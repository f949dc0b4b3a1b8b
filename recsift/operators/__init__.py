"""DataFrame -> DataFrame operators (cleaning, statistics, content, ALS, evaluation)."""
