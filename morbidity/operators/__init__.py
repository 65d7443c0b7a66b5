"""DataFrame-in, DataFrame-out operators. All are lazy unless their docstring says otherwise."""
