"""DataFrame-in, DataFrame-out operators; none of them runs an action unless its docstring says so."""
