"""Training-data operators: each module holds one operator, ``queries`` the
catalogue entries built from them."""
