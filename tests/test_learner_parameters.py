"""Registered learner queries run with the reference's parameters."""

import re

from turnfold.plans import catalogue


def test_no_learner_query_cuts_rounds_or_trees():
    source = open(catalogue.__file__, encoding="utf-8").read()
    cut = re.findall(r"\b(?:num_trees|rounds|max_iter|groups|n_features)=\d+", source)
    assert not cut, cut
    assert 'TR.fit_pca(sc.transform(cached), "scaled", 200,' in source
