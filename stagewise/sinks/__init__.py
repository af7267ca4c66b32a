"""Writing stages and registering them."""
