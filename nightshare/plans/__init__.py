"""Silver and gold builders and the analyses built on them."""
