"""DataFrame building blocks. A fitted step comes as ``fit_*`` (returns a small table or list) and an
apply function, so that what is learned on the training rows can be used on any other rows."""
