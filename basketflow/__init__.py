"""basketflow: retail-basket cleaning, features, recommendations on PySpark."""
