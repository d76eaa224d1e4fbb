import math

import numpy as np
import pytest

from exprspark.functions import stats


def brute_hyper(k, m, n, total):
    return sum(math.comb(m, i) * math.comb(total - m, n - i) for i in range(k, min(m, n) + 1)) / math.comb(total, n)


@pytest.mark.parametrize("k,m,n,total", [(1, 5, 4, 20), (3, 10, 12, 100), (10, 10, 12, 100), (0, 4, 4, 9), (30, 300, 200, 2000)])
def test_hypergeom(k, m, n, total):
    got = stats.hypergeom_upper([k], [m], [n], [total])[0]
    assert got == pytest.approx(brute_hyper(k, m, n, total), rel=1e-9)


@pytest.mark.parametrize("k,mu", [(0, 2.0), (1, 0.3), (5, 2.0), (5, 9.0), (40, 10.0), (3, 50.0), (200, 150.0)])
def test_poisson(k, mu):
    logs = [i * math.log(mu) - mu - math.lgamma(i + 1) for i in range(0, 2000)]
    want = sum(math.exp(v) for v in logs[k:])
    assert stats.poisson_upper([k], [mu])[0] == pytest.approx(want, rel=1e-8)


# Published table values.
@pytest.mark.parametrize("p,df,t", [(0.975, 1, 12.7062047), (0.975, 2, 4.30265273), (0.975, 10, 2.22813885), (0.95, 30, 1.69726089), (0.975, 1000, 1.96233908)])
def test_t_quantile(p, df, t):
    assert stats.t_quantile(p, df) == pytest.approx(t, rel=1e-7)
    assert stats.t_quantile(1 - p, df) == pytest.approx(-t, rel=1e-7)


def test_chi2_and_normal():
    assert stats.chi2_upper([3.841458820694124], [1])[0] == pytest.approx(0.05)
    assert stats.chi2_upper([5.991464547107979], [2])[0] == pytest.approx(0.05)
    assert stats.normal_two_sided_p([1.959963984540054])[0] == pytest.approx(0.05)
    assert np.isnan(stats.t_quantile(0.975, 0))
